"""Language of a text by a bidirectional gated recurrent network over its bytes, in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .common import row_key, text_of

#: Units of each direction.
HIDDEN = 6
#: Bytes of a stretch: a text is read in stretches one after another, each from a zero state.
STRETCH = 128
#: Stretches that are read side by side; bounds a worker's memory.
SIDE = 2048
#: Bytes of texts that are cut into stretches at a time, and the rows of a batch that are read at a time.
TOGETHER, ROWS = 2 << 20, 1000
#: The training sample's bound: documents of each language, excerpts of each document, characters of each excerpt.
SAMPLE_DOCS, EXCERPTS, EXCERPT_CHARS = 256, 6, 160
#: The most languages that are learned, those with the most rows; bounds what the driver and each task hold of them.
LANGUAGES = 1000
#: Share of positions that a text's language must label, in texts of at least so many bytes, to be accepted.
LEAST_LABELLED, JUDGED_BYTES = 0.3, 100
PAD = 256
UNKNOWN = "und"


@dataclass
class Direction:
    """Weights of one direction, laid out with the batch last. Column PAD of the byte tables is zero, so a zero state stays zero over padding."""

    gates_byte: np.ndarray  # (2H, 257): reset and update, the bytes' part
    new_byte: np.ndarray  # (H, 257)
    state: np.ndarray  # (3H, H): reset, update and new, the state's part

    @classmethod
    def drawn(cls, rng: np.random.Generator, hidden: int) -> Direction:
        gates, new = rng.normal(0, 0.3, (2 * hidden, PAD + 1)), rng.normal(0, 0.5, (hidden, PAD + 1))
        gates[:, PAD], new[:, PAD] = 0, 0
        return cls(*(x.astype(np.float32) for x in (gates, new, rng.normal(0, 0.3, (3 * hidden, hidden)))))

    def parameters(self) -> list[np.ndarray]:
        return [self.gates_byte, self.new_byte, self.state]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _forward(d: Direction, steps: np.ndarray) -> tuple[np.ndarray, list[tuple]]:
    """States (T, H, N) after each of the ``steps`` (T, N) of bytes, and what the way back needs."""
    hidden = d.new_byte.shape[0]
    h, states, kept = np.zeros((hidden, steps.shape[1]), np.float32), [], []
    for x in steps:
        a = d.state @ h
        rz = _sigmoid(a[: 2 * hidden] + d.gates_byte[:, x])
        r, z, m = rz[:hidden], rz[hidden:], a[2 * hidden :]
        n = np.tanh(d.new_byte[:, x] + r * m)
        kept.append((h, r, z, m, n))
        h = n + z * (h - n)
        states.append(h)
    return np.stack(states), kept


def _backward(d: Direction, steps: np.ndarray, kept: list[tuple], dstates: np.ndarray) -> list[np.ndarray]:
    """Gradients of the parameters by back-propagation through time; ``dstates`` (T, H, N) comes from the output."""
    hidden = d.new_byte.shape[0]
    dstate, dh = np.zeros_like(d.state), np.zeros_like(dstates[0])
    dbytes = np.zeros((3 * hidden, len(steps), steps.shape[1]), np.float32)
    for t in range(len(steps) - 1, -1, -1):
        h, r, z, m, n = kept[t]
        dh = dh + dstates[t]
        dn = dh * (1 - z) * (1 - n * n)
        da = np.concatenate([dn * m * r * (1 - r), dh * (h - n) * z * (1 - z), dn * r])
        dstate += da @ h.T
        dbytes[: 2 * hidden, t], dbytes[2 * hidden :, t] = da[: 2 * hidden], dn
        dh = dh * z + d.state.T @ da
    flat = steps.ravel()
    dtable = np.stack([np.bincount(flat, weights=row, minlength=PAD + 1) for row in dbytes.reshape(3 * hidden, -1)]).astype(np.float32)
    dtable[:, PAD] = 0
    return [dtable[: 2 * hidden], dtable[2 * hidden :], dstate]


@dataclass
class Model:
    languages: list[str]
    ahead: Direction
    back: Direction
    out: np.ndarray  # (L, 2H + 1): from both states, and a constant


def _stretches(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """(n, length) bytes of all texts, the last stretch of each filled up with PAD, and the text of each stretch."""
    sizes = np.array([len(t) for t in texts], np.int64)
    counts = -(-sizes // length)
    cells = np.full((int(counts.sum()), length), PAD, np.int16)
    flat, raw = cells.reshape(-1), np.frombuffer(b"".join(texts), np.uint8)
    starts, at = np.r_[0, np.cumsum(counts)] * length, np.r_[0, np.cumsum(sizes)]
    for i, size in enumerate(sizes):
        flat[starts[i] : starts[i] + size] = raw[at[i] : at[i] + size]
    return cells, np.repeat(np.arange(len(texts)), counts)


def train(texts: list[str], labels: list[str], hidden: int = HIDDEN, steps: int = 300, batch: int = 128, length: int = 64, rate: float = 0.02, seed: int = 7) -> Model:
    """Fit by Adam on stretches of the excerpts; the loss is the mean cross-entropy over every position. Languages weigh equally."""
    languages, rng = sorted(set(labels)), np.random.default_rng(seed)
    cells, owner = _stretches([t.encode() for t in texts], length)
    target = np.array([languages.index(x) for x in labels])[owner]
    by_language = [np.flatnonzero(target == k) for k in range(len(languages))]
    by_language = [x for x in by_language if len(x)]
    model = Model(languages, Direction.drawn(rng, hidden), Direction.drawn(rng, hidden), rng.normal(0, 0.3, (len(languages), 2 * hidden + 1)).astype(np.float32))
    parameters = [*model.ahead.parameters(), *model.back.parameters(), model.out]
    first, second = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters]
    for step in range(1, steps + 1 if by_language else 1):
        picked = np.array([rng.choice(by_language[i % len(by_language)]) for i in range(batch)])
        x, y = cells[picked].T.astype(np.intp), target[picked]
        ahead, kept_a = _forward(model.ahead, x)
        back, kept_b = _forward(model.back, x[::-1])
        both = np.concatenate([ahead, back[::-1], np.ones((len(x), 1, batch), np.float32)], axis=1)
        logits = np.einsum("lh,thn->tln", model.out, both)
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[:, y, np.arange(batch)] -= 1
        p *= (x != PAD)[:, None, :] / max(1, (x != PAD).sum())
        p = p.astype(np.float32)
        dboth = np.einsum("lh,tln->thn", model.out, p)
        grads = [
            *_backward(model.ahead, x, kept_a, dboth[:, :hidden]),
            *_backward(model.back, x[::-1], kept_b, dboth[::-1, hidden : 2 * hidden]),
            np.einsum("tln,thn->lh", p, both),
        ]
        size = np.sqrt(sum(float((g * g).sum()) for g in grads))
        now = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for v, g, a, b in zip(parameters, grads, first, second, strict=True):
            g = g * min(1.0, 1.0 / max(size, 1e-9))
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            v -= now * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
    return model


class Reader:
    """Labels every position of whole texts and pools the probabilities of each text."""

    def __init__(self, model: Model):
        self._model = model
        # sigmoid(x) = (tanh(x / 2) + 1) / 2: the half goes into the weights of the gates.
        self._ways = []
        for d in (model.ahead, model.back):
            hidden = d.new_byte.shape[0]
            half = np.r_[np.full(2 * hidden, 0.5), np.full(hidden, 0.5)].astype(np.float32)  # the new part is halved for (tanh + 1) * m / 2
            self._ways.append((np.ascontiguousarray(0.5 * d.gates_byte), np.ascontiguousarray(d.new_byte), np.ascontiguousarray(d.state * half[:, None])))

    @staticmethod
    def _states(way: tuple, steps: np.ndarray) -> Iterator[np.ndarray]:
        gates_byte, new_byte, state = way
        hidden, n = new_byte.shape[0], steps.shape[1]
        h, a = np.zeros((hidden, n), np.float32), np.empty((3 * hidden, n), np.float32)
        gates, new = np.empty((2 * hidden, n), np.float32), np.empty((hidden, n), np.float32)
        rz, m = a[: 2 * hidden], a[2 * hidden :]
        r, z = rz[:hidden], rz[hidden:]
        for x in steps:
            np.matmul(state, h, out=a)
            np.take(gates_byte, x, axis=1, out=gates, mode="clip")
            np.take(new_byte, x, axis=1, out=new, mode="clip")
            rz += gates
            np.tanh(rz, out=rz)
            rz += 1
            m *= r
            m += new
            np.tanh(m, out=m)
            z *= 0.5
            h -= m
            h *= z
            h += m
            yield h

    def _pooled(self, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums of the positions' probabilities of each stretch (L, n), and the positions of each language (L, n)."""
        model, hidden = self._model, self._model.ahead.new_byte.shape[0]
        steps = np.ascontiguousarray(cells.T).astype(np.intp)
        out_a, out_b, constant = model.out[:, :hidden].copy(), model.out[:, hidden : 2 * hidden].copy(), model.out[:, 2 * hidden :]
        from_back = np.empty((len(steps), len(model.languages), steps.shape[1]), np.float32)
        for t, h in enumerate(self._states(self._ways[1], steps[::-1])):
            np.matmul(out_b, h, out=from_back[-1 - t])
        from_back += constant
        sums, labels = np.zeros_like(from_back[0]), np.zeros_like(from_back[0])
        for t, h in enumerate(self._states(self._ways[0], steps)):
            p = from_back[t]
            p += out_a @ h
            top = p.max(axis=0)
            labels += (p == top) & (steps[t] != PAD)
            p -= top
            np.exp(p, out=p)
            p *= (steps[t] != PAD) / p.sum(axis=0)
            sums += p
        return sums, labels

    def read(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(len(texts), L) mean probabilities, and the share of positions that each language labels."""
        if len(texts) > 1 and sum(map(len, texts)) > TOGETHER:
            half = len(texts) // 2
            parts = [self.read(texts[:half]), self.read(texts[half:])]
            return np.concatenate([p for p, _ in parts]), np.concatenate([y for _, y in parts])
        cells, owner = _stretches(texts, STRETCH)
        sums, labels = np.zeros((2, len(texts), len(self._model.languages)))
        for i in range(0, len(cells), SIDE):
            p, y = self._pooled(cells[i : i + SIDE])
            np.add.at(sums, owner[i : i + SIDE], p.T)
            np.add.at(labels, owner[i : i + SIDE], y.T)
        n = np.maximum(1, np.array([len(t) for t in texts]))[:, None]
        return sums / n, labels / n


def held_out(column: str = "doc_id", folds: int = 3, fold: int = 1) -> Column:
    """Whether a row is kept from training: CRC-32 of its id as text, modulo ``folds``; NULL ids are not."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % folds == fold, F.lit(False))


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model | None:
    """The network fitted on a bounded sample of ``docs`` (doc_id, text, lang); None without labelled rows.

    Of each language up to ``sample_docs`` rows, by the hash of their id, one for each id, that are not held out, of
    each EXCERPTS excerpts spread over its text: what reaches the driver is bounded by these and LANGUAGES.
    """
    usable = F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()
    keyed = docs.where(usable).select("doc_id", "lang", "text", row_key("doc_id", "lang", "text").alias("picked"), F.xxhash64("doc_id").alias("h"))
    # Languages and about how many ids each has; one sketch of each travels from a task.
    found = keyed.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("ids"), F.count("*").alias("n"))
    found = found.orderBy(F.col("n").desc(), "lang").limit(LANGUAGES).collect()
    if not found:
        return None
    # Twice the wanted share of each language by hash, taken as rows are read: what goes on is about that many ids, however large the language.
    shares = docs.sparkSession.createDataFrame([(r.lang, min(1.0, 2.0 * sample_docs / max(1, r.ids))) for r in found], f"lang {docs.schema['lang'].dataType.simpleString()}, share double")
    drawn = keyed.join(F.broadcast(shares), "lang").where(F.shiftrightunsigned("h", 11) < F.col("share") * F.lit(2.0**53))
    # One row for each id and language, however many have the id.
    labelled = drawn.groupBy("doc_id", "lang", "h").agg(F.min("picked").alias("picked"))
    place = Window.partitionBy("lang").orderBy("h", "doc_id")
    keys = labelled.withColumn("k", F.row_number().over(place)).where(F.col("k") <= sample_docs).select("picked").distinct()
    n = F.char_length("text")
    at = lambda i: F.substring(F.col("text"), (n * F.lit(i) / F.lit(EXCERPTS)).cast("int") + 1, F.lit(EXCERPT_CHARS))
    # At most ``sample_docs`` keys for each language; of equal rows one.
    chosen = keyed.join(F.broadcast(keys), "picked")
    chosen = chosen.select("picked", "doc_id", "lang", F.array_distinct(F.array(*[at(i) for i in range(EXCERPTS)])).alias("excerpts")).dropDuplicates(["picked"])
    rows = sorted(((r.lang, r.doc_id, e) for r in chosen.collect() for e in r.excerpts if e), key=lambda r: (r[0], r[1], r[2]))
    return train([r[2] for r in rows], [r[0] for r in rows]) if rows else None


def _read_languages(rows: DataFrame, model: Model | None, keep: bool = False) -> DataFrame:
    """``rows``, whose last column is a text or a struct that has one, with its lang_pred, score and labelled in place of it, or with ``keep`` after it."""
    columns = rows.columns if keep else rows.columns[:-1]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, letter = (Reader(model) if model else None), regex.compile(r"\p{L}")
        for batch in (whole.slice(at, ROWS) for whole in batches for at in range(0, whole.num_rows, ROWS)):
            last = batch.column(batch.num_columns - 1)
            texts = (last.field("text") if pa.types.is_struct(last.type) else last).to_pylist()
            known = [i for i, t in enumerate(texts) if reader and t and letter.search(t)]
            found, score, labelled = [UNKNOWN] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
            if known:
                p, y = reader.read([texts[i].encode() for i in known])
                for i, best, a, b in zip(known, p.argmax(axis=1), p, y, strict=True):
                    found[i], score[i], labelled[i] = model.languages[best], min(1.0, float(a[best])), min(1.0, float(b[best]))
            read = [pa.array(found, pa.string()), pa.array(score, pa.float64()), pa.array(labelled, pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(columns)], *read], names=[*columns, "lang_pred", "score", "labelled"])

    schema = rows.select(columns).schema.add("lang_pred", "string").add("score", "double").add("labelled", "double")
    return rows.mapInArrow(predict, schema)


def identify_language(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """The language of every whole text of ``docs`` (doc_id, text, and lang for training).

    Every byte of a text is labelled by the states of both directions at it, and the text has the language with
    the largest mean probability; of equal ones the first by name. NULL text, text without a letter, and every text if nothing
    could be learned: ``und`` with score 0. Repeated rows and NULL ids are rows like others; an empty table gives an empty result; extra
    columns are ignored. Returns doc_id, held_out, lang_pred, score, labelled (the share of positions labelled so).
    """
    model = model or fit(docs)  # some KB, sent with the tasks
    return _read_languages(docs.select("doc_id", held_out().alias("held_out"), text_of().alias("text")), model)


def accepted_languages(docs: DataFrame, model: Model | None = None, least: float = 0.0, least_labelled: float = LEAST_LABELLED) -> DataFrame:
    """``docs`` (doc_id, text, lang and any others) without texts of no language.

    A text without a letter goes; so does one of JUDGED_BYTES or more whose language labels less than ``least_labelled`` of its positions:
    the network sees a bit of every language in it and none throughout. The default is low, since few clean texts have shares down to 0.39 and
    random letters or base64 have 0.33 to 0.6, so a higher one costs clean texts. Shorter texts are not judged by it, and by default none goes for its score. If nothing is labelled there
    is no network, and every text with a letter stays. Repeated rows, NULL ids and extra columns are kept as they are; an empty table stays empty.
    """
    model = model or fit(docs)
    if model is None:
        return docs.where(text_of().rlike(r"\p{L}"))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    # The text goes to Python once, inside the row.
    inside = docs.schema["text"].dataType == StringType()
    read = _read_languages(docs.select(whole) if inside else docs.select(whole, text_of().alias("text")), model, inside)
    judged = F.octet_length(F.col("doc.text").cast("string")) >= JUDGED_BYTES
    clear = (F.col("score") >= least) & (~judged | (F.col("labelled") >= least_labelled))
    return read.where((F.col("lang_pred") != UNKNOWN) & clear).select("doc.*")
