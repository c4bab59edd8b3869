"""SentencePiece models of the merge kind: an agenda of adjacent pairs by score, for many new words at once; what it makes of each word is held against the library, batch by batch."""

from __future__ import annotations

import hashlib
import heapq
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, islice, pairwise

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from .common import text_of

MODEL = "piece_bpe_32k.model"
#: The sign that stands for a space inside pieces.
MARK = "▁"
#: Stretches whose ids are kept at once in a worker, and the longest of them.
CACHE, CACHED_CHARS = 500_000, 64
#: Words handled at a time; bounds the memory that a very long text takes.
WORDS = 200_000
#: Characters of texts whose new words go through one agenda, and the rows of words it has at a time.
TOGETHER, ROWS = 1 << 20, 4096
#: New words after which the library is asked for their ids.
FRESH = 30_000
#: The turn of a pair that is no piece.
NEVER = np.iinfo(np.int32).max


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a serialised message: variable-length integers, fixed words, and strings."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(key & 7) or number()
        yield key >> 3, raw[at : at + size]
        at += size


@dataclass
class Settings:
    """What a model says of its kind and of the way its texts are made ready. Field numbers are fixed values of the format."""

    merges: bool = False
    dummy_prefix: bool = True
    plain: bool = True

    @classmethod
    def read(cls, raw: bytes) -> Settings:
        out = cls()
        for field, value in _fields(raw):
            if field == 1:  # a piece
                if any(f == 3 and v == 4 for f, v in _fields(value)):  # of the user's own
                    out.plain = False
            elif field == 2:  # the trainer's settings
                for f, v in _fields(value):
                    if f == 3:  # kind of model: 2 is merges
                        out.merges = v == 2
                    elif f == 24 and v:  # the mark as a suffix
                        out.plain = False
            elif field == 3:  # the normaliser's settings
                removes = True
                for f, v in _fields(value):
                    if f == 2 and v:  # a table of replacements
                        out.plain = False
                    elif f == 3:
                        out.dummy_prefix = bool(v)
                    elif f == 4:
                        removes = bool(v)
                    elif f == 5 and not v:  # spaces are not escaped
                        out.plain = False
                out.plain = out.plain and not removes
        return out


class PieceBpe:
    """Encoder and decoder of one model; made once for each worker, which keeps what it knows of words from task to task.

    Takes models of the merge kind that read texts as they are: no table of replacements, no removal of spaces, no pieces
    of the user's own. Any other model is refused.
    """

    def __init__(self, raw: bytes, check: bool = False):
        self.library = lib = sentencepiece.SentencePieceProcessor(model_proto=raw)
        settings = Settings.read(raw)
        n = lib.get_piece_size()
        names = [lib.id_to_piece(i) for i in range(n)]
        special = [lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) for i in range(n)]
        if not (settings.merges and settings.plain):
            raise ValueError("only models of the merge kind that take texts as they are")
        self._prefix = settings.dummy_prefix
        self._id = {p: i for i, p in enumerate(names) if not special[i]}
        self._turn = {p: -lib.get_score(i) for p, i in self._id.items()}  # the least comes first
        self._unused = {p for p, i in self._id.items() if lib.is_unused(i)}
        bytes_of = {int(names[i][3:-1], 16): i for i in range(n) if lib.is_byte(i)}
        self._unknown = lib.unk_id()
        self._byte = [bytes_of[b] for b in range(256)] if len(bytes_of) == 256 else None
        # Without a piece that goes on with the mark after another character, no merge reaches over the start of a word.
        self._words = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+$") if not any(MARK in p.lstrip(MARK) for p in self._id) else None
        self._beside = {p[i : i + 2] for p in self._id for i in range(len(p) - 1)}
        self._cache: dict[str, tuple[tuple[int, ...], str, bytes]] = {}
        #: With ``check``: words met since the last ``compare`` with their ids, and words of which the library makes something else.
        self._check = check
        self._fresh: list[tuple[str, tuple[int, ...]]] = []
        self.differs: set[str] = set()
        # Decoding: the bytes of every id.
        back = {i: bytes([b]) for b, i in bytes_of.items()}
        surface = lambda i: b"" if lib.is_control(i) else " ⁇ ".encode() if i == self._unknown else names[i].replace(MARK, " ").encode()
        self._bytes = [back.get(i) or surface(i) for i in range(n)]
        self._is_byte = [i in back for i in range(n)]
        self._marked = [not special[i] and names[i].startswith(MARK) for i in range(n)]
        self._decimal = [str(i) for i in range(n)]
        self._decimals, self._backs = _table([f"{x},".encode() for x in self._decimal]), _table(self._bytes)
        self._pairs()

    def _pairs(self) -> None:
        """The pairs of pieces that make a piece, sorted by key, with their turns and what they make; the pieces of one character by code point."""
        n = self._n = self.library.get_piece_size()
        turns = sorted(set(self._turn.values()))
        place = {t: i for i, t in enumerate(turns)}
        known = self._id
        found = [(known[p[:k]] * (n + 2) + known[p[k:]], place[self._turn[p]], i) for p, i in known.items() for k in range(1, len(p)) if p[:k] in known and p[k:] in known]
        table = np.array(sorted(found), np.int64).reshape(-1, 3)
        self._key, self._key_turn, self._key_makes = table[:, 0].copy(), table[:, 1].astype(np.int32), table[:, 2].astype(np.int32)
        self._single = np.full(0x110000, n + 1, np.int32)
        for p, i in known.items():
            if len(p) == 1:
                self._single[ord(p)] = i
        # A character of one byte that is no piece is the piece of its byte, which nothing is merged with.
        if self._byte:
            plain = self._single[:128]
            plain[:] = np.where(plain > n, self._byte[:128], plain)

    def _looked_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Turns of pairs of ids, and the ids they make; the two ids after the last one stand for none and for a character that is no piece."""
        wanted = left.astype(np.int64) * (self._n + 2) + right
        at = np.minimum(np.searchsorted(self._key, wanted), len(self._key) - 1)
        hit = self._key[at] == wanted
        return np.where(hit, self._key_turn[at], NEVER), self._key_makes[at]

    def _agenda(self, ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows of ids, filled up by the id of none: row numbers and rows of those that are done, as they get done.

        Each row has its agenda, the turns of its pairs in their places; in each round the first least pair of every row is made one.
        """
        rows = np.arange(len(ids))
        turns, makes = self._looked_up(ids[:, :-1], ids[:, 1:])
        while turns.shape[1]:
            at = turns.argmin(1)
            go = turns[np.arange(len(rows)), at] != NEVER
            if not go.all():
                yield rows[~go], ids[~go]
                rows, ids, turns, makes, at = rows[go], ids[go], turns[go], makes[go], at[go]
            if not len(rows):
                return
            each, column = np.arange(len(rows)), at[:, None]
            ids[each, at] = makes[each, at]
            ids = np.where(np.arange(ids.shape[1] - 1) > column, ids[:, 1:], ids[:, :-1])
            late = np.arange(turns.shape[1] - 1) >= column
            turns, makes = np.where(late, turns[:, 1:], turns[:, :-1]), np.where(late, makes[:, 1:], makes[:, :-1])
            for which, first in ((at > 0, at - 1), (at < turns.shape[1], at)):
                r, i = each[which], first[which]
                turns[r, i], makes[r, i] = self._looked_up(ids[r, i], ids[r, i + 1])
        yield rows, ids

    def learn(self, words: set[str]) -> None:
        """Keep the ids of new short words, many of them through one agenda."""
        if self._unused or not self._byte or not self._key.size:
            return
        listed = sorted((w for w in words if len(w) <= CACHED_CHARS), key=len)
        for start in range(0, len(listed), ROWS):
            some = listed[start : start + ROWS]
            sizes = np.fromiter(map(len, some), np.int64, len(some))
            singles = self._single[np.frombuffer("".join(some).encode("utf-32-le", "surrogatepass"), np.uint32)]
            ids = np.full((len(some), int(sizes[-1])), self._n, np.int32)
            ids[np.arange(ids.shape[1]) < sizes[:, None]] = singles
            parts = [(rows, done[done != self._n], (done != self._n).sum(1)) for rows, done in self._agenda(ids)]
            order, flat, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
            self._keep([some[i] for i in order.tolist()], flat, counts)
            if len(self._fresh) >= FRESH:
                self.compare()

    def _keep(self, words: list[str], flat: np.ndarray, counts: np.ndarray) -> None:
        """The records of words whose ids stand one after another, ``counts`` for each; decimals and bytes of all are looked up at once."""
        ends = np.cumsum(counts)
        odd = np.unique(np.searchsorted(ends, np.flatnonzero(flat > self._n), "right")).tolist()
        known = np.where(flat > self._n, self._unknown, flat)
        decimals, decimal_ends = self._strung(self._decimals, known, ends)
        back, back_ends = self._strung(self._backs, known, ends)
        decimals, ids = decimals.decode(), flat.tolist()
        ends, decimal_ends, back_ends = ([0, *x.tolist()] for x in (ends, decimal_ends, back_ends))
        found = [tuple(ids[i:j]) for i, j in pairwise(ends)]
        records = list(zip(found, [decimals[i : j - 1] for i, j in pairwise(decimal_ends)], [back[i:j] for i, j in pairwise(back_ends)], strict=True))
        for k in odd:
            found[k] = tuple(self._spelt(words[k], found[k]))
            records[k] = self._record(words[k], found[k])
        if not odd and back == "".join(words).replace(MARK, " ").encode():
            differ = ()  # ids that are pieces of the words decode to them
        else:
            differ = (k for k, (word, (_, _, raw)) in enumerate(zip(words, records, strict=True)) if raw != word.replace(MARK, " ").encode())
        for k in differ:
            records[k] = self._record(words[k], found[k])
        self._cache.update(zip(words, records, strict=True))
        if self._check:
            self._fresh += zip(words, found, strict=True)

    @staticmethod
    def _strung(table: tuple[np.ndarray, np.ndarray, np.ndarray], ids: np.ndarray, ends: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The entries of ``ids`` one after another, and where those up to each of ``ends`` end."""
        raw, starts, sizes = table
        size = sizes[ids]
        after = np.cumsum(size)
        return raw[np.repeat(starts[ids] - after + size, size) + np.arange(after[-1])].tobytes(), after[ends - 1]

    def _spelt(self, word: str, ids: tuple[int, ...]) -> Iterator[int]:
        """``ids`` with the characters that are no pieces, which stand in the word's order, as bytes."""
        others = (c for c in word if self._single[ord(c)] > self._n)
        for i in ids:
            if i > self._n:
                yield from (self._byte[b] for b in next(others).encode())
            else:
                yield i

    def _record(self, word: str, ids: tuple[int, ...]) -> tuple[tuple[int, ...], str, bytes]:
        """A word's ids, the same in decimals, and what they decode to but for the dummy space."""
        raw = b"".join(map(self._bytes.__getitem__, ids))
        return ids, self.decimal(ids), raw if raw == word.replace(MARK, " ").encode() else b"".join(self._joined(list(ids)))

    def coded_all(self, texts: list[str]) -> Iterator[tuple[int, str, bytes]]:
        """For each text the number of its ids, the ids in decimals joined by commas, and what they decode to.

        Where every word but the first begins with the piece of the mark or a longer one, no run of bytes and no run of unknown pieces reaches over its
        start, so what is known of the words is put together.
        """
        if not (self._words and self._byte and MARK in self._id and not self._unused):
            for ids in self.encode_all(texts):
                yield len(ids), self.decimal(ids), self.decode(ids)
            return
        for records in self._records(texts):
            ids, decimals, parts = zip(*records, strict=True) if records else ((), (), ())
            out = b"".join(parts)
            yield sum(map(len, ids)), ",".join(decimals), out[1:] if self._prefix and out else out

    def _records(self, texts: list[str]) -> Iterator[list[tuple[tuple[int, ...], str, bytes]]]:
        """The records of the words of each text; texts go together up to a number of characters, so that their new words share an agenda."""
        known, start = self._cache.get, 0
        while start < len(texts):
            end, size = start, 0
            while end < len(texts) and (end == start or size + len(texts[end]) <= TOGETHER):
                size += len(texts[end])
                end += 1
            if size > TOGETHER:
                parts = self.words(texts[start])
                yield [known(w) or self._new(w) for words in parts for w in self._learnt(words)]
            else:
                words = [list(chain.from_iterable(self.words(t))) for t in texts[start:end]]
                self._learnt(list(chain.from_iterable(words)))
                for some in words:
                    records = list(map(known, some))
                    yield records if all(records) else [r or known(w) or self._new(w) for r, w in zip(records, some, strict=True)]
            start = end

    def _learnt(self, words: list[str]) -> list[str]:
        # A full cache keeps only the words of these texts, before the new ones are told from the known ones: all that these texts need is learnt together.
        wanted = set(words)
        if len(self._cache) >= CACHE:
            some = {w: self._cache[w] for w in wanted.intersection(self._cache)}
            self._cache.clear()
            self._cache.update(some)
        self.learn(wanted.difference(self._cache))
        return words

    def encode_all(self, texts: list[str]) -> Iterator[list[int]]:
        """The ids of each text."""
        for records in self._records(texts):
            yield self._one_unknown(list(chain.from_iterable([ids for ids, _, _ in records])))

    def _split(self, text: str) -> list[str]:
        """Symbols of a stretch that no merge leaves."""
        parts: dict[str, tuple[str, str]] = {}  # of unused pieces
        out = (self._few if len(text) <= CACHED_CHARS else self._many)(text, parts)
        return [p for piece in out for p in self._resolved(piece, parts)] if parts else out

    def _few(self, text: str, parts: dict[str, tuple[str, str]]) -> list[str]:
        """A short stretch: the agenda is the list of the pairs' turns in their places; its first least one is next."""
        turn, never, unused = self._turn.get, math.inf, self._unused
        symbols = list(text)
        agenda = [turn(a + b, never) for a, b in zip(symbols, symbols[1:])]  # noqa: B905
        while agenda and (best := min(agenda)) is not never:
            i = agenda.index(best)
            piece = symbols[i] + symbols[i + 1]
            if piece in unused:
                parts[piece] = symbols[i], symbols[i + 1]
            symbols[i : i + 2] = (piece,)
            del agenda[i]
            if i:
                agenda[i - 1] = turn(symbols[i - 1] + piece, never)
            if i < len(agenda):
                agenda[i] = turn(piece + symbols[i + 1], never)
        return symbols

    def _many(self, text: str, parts: dict[str, tuple[str, str]]) -> list[str]:
        """A long stretch: the agenda is a heap of pairs by turn, then place.

        A symbol is known by its start; ``after`` and ``before`` link the starts, so a symbol's end is its follower's start.
        """
        size = len(text)
        after, before = list(range(1, size + 1)), list(range(-1, size))
        alive = bytearray(b"\1") * size
        agenda: list[tuple[float, int, int]] = []
        turn = self._turn.get

        def offer(left: int) -> None:
            end = after[after[left]]
            known = turn(text[left:end])
            if known is not None:
                heapq.heappush(agenda, (known, left, end))

        for left in range(size - 1):
            offer(left)
        while agenda:
            _, left, end = heapq.heappop(agenda)
            middle = after[left] if alive[left] else end
            # A pair whose symbols have grown since it was offered is out.
            if middle >= end or after[middle] != end:
                continue
            if text[left:end] in self._unused:
                parts[text[left:end]] = text[left:middle], text[middle:end]
            alive[middle] = 0
            after[left], before[end] = end, left
            if before[left] >= 0:
                offer(before[left])
            if end < size:
                offer(left)
        out, at = [], 0
        while at < size:
            out.append(text[at : after[at]])
            at = after[at]
        return out

    def _resolved(self, piece: str, parts: dict[str, tuple[str, str]]) -> list[str]:
        """An unused piece goes back to the parts it was made of."""
        done, todo = [], [piece]
        while todo:
            p = todo.pop()
            if p in self._unused and p in parts:
                todo += reversed(parts[p])
            else:
                done.append(p)
        return done

    def _stretches(self, word: str) -> Iterator[str]:
        """A long word cut between characters that stand side by side in no piece."""
        start = 0
        for i in range(1, len(word)):
            if word[i - 1 : i + 1] not in self._beside:
                yield word[start:i]
                start = i
        yield word[start:]

    def _ids(self, word: str) -> tuple[int, ...]:
        pieces = self._split(word) if len(word) <= CACHED_CHARS else [p for stretch in self._stretches(word) for p in self._split(stretch)]
        ids = list(map(self._id.get, pieces))
        if None in ids:
            byte = self._byte
            spelt = ((i,) if i is not None else [byte[b] for b in p.encode()] if byte else (self._unknown,) for i, p in zip(ids, pieces, strict=True))
            ids = list(chain.from_iterable(spelt))
        found = tuple(self._one_unknown(ids))
        if self._check:
            self._fresh.append((word, found))
            if len(self._fresh) >= FRESH:
                self.compare()
        return found

    def _new(self, word: str) -> tuple[tuple[int, ...], str, bytes]:
        found = self._record(word, self._ids(word))
        if len(word) <= CACHED_CHARS:
            if len(self._cache) >= CACHE:
                self._cache.clear()
            self._cache[word] = found
        return found

    def words(self, text: str) -> Iterator[list[str]]:
        """The words of a text made ready, some at a time; merges stay inside them."""
        if not text:
            return
        ready = (MARK if self._prefix else "") + text.replace(" ", MARK)
        if not self._words:
            yield [ready]
        elif len(ready) <= WORDS:
            yield self._words.findall(ready)
        else:
            found = self._words.finditer(ready)
            while some := [m.group() for m in islice(found, WORDS)]:
                yield some

    def encode(self, text: str) -> list[int]:
        known = self._cache.get
        ids = [i for words in self.words(text) for i in chain.from_iterable([(known(w) or self._new(w))[0] for w in words])]
        return self._one_unknown(ids)

    def _one_unknown(self, ids: list[int]) -> list[int]:
        """Without pieces for bytes, unknown pieces side by side are one."""
        return ids if self._byte else [i for n, i in enumerate(ids) if not (n and i == self._unknown == ids[n - 1])]

    def compare(self) -> None:
        """Note in ``differs`` each word met since the last call for which the library gives other ids."""
        fresh, self._fresh = self._fresh, []
        # The library sets the dummy mark itself; a word that is that mark only is one symbol, and cannot be given to it as a text.
        fresh = [x for x in fresh if x[0] != MARK]
        plain = [(w[1:] if self._prefix else w).replace(MARK, " ") for w, _ in fresh]
        theirs = self.library.encode(plain, num_threads=1) if plain else []
        self.differs.update(w for (w, ids), want in zip(fresh, theirs, strict=True) if tuple(want) != ids)

    def decode(self, ids: list[int]) -> bytes:
        """The text of the ids in UTF-8: bytes are joined to characters, each byte of none becomes U+FFFD, and the dummy space goes."""
        parts = list(map(self._bytes.__getitem__, ids))
        out = b"".join(parts)
        try:
            out.decode()
            whole = b"" not in parts  # a control id ends a run of bytes
        except UnicodeDecodeError:
            whole = False
        if not whole:
            out = b"".join(self._joined(ids))
        first = next((i for i in ids if self._bytes[i]), None)
        return out[1:] if self._prefix and first is not None and self._marked[first] else out

    def _joined(self, ids: list[int]) -> Iterator[bytes]:
        run = b""
        for i in [*ids, None]:
            if i is not None and self._is_byte[i]:
                run += self._bytes[i]
                continue
            at = 0
            while at < len(run):
                size = next((n for n in (1, 2, 3, 4) if _character(run[at : at + n], n)), 0)
                yield run[at : at + size] if size else "�".encode()
                at += size or 1
            run = b""
            if i is not None:
                yield self._bytes[i]

    def decimal(self, ids: list[int]) -> str:
        return ",".join(map(self._decimal.__getitem__, ids))


def _table(entries: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries one after another, where each starts, and its size."""
    sizes = np.array([len(x) for x in entries], np.int64)
    return np.frombuffer(b"".join(entries), np.uint8), np.cumsum(sizes) - sizes, sizes


def _character(raw: bytes, size: int) -> bool:
    try:
        return len(raw) == size and len(raw.decode()) == 1
    except UnicodeDecodeError:
        return False


def _coder(spark, path: str | None, check: bool = False):
    """A function that gives the coder in a task. The model file (its size is the vocabulary's) is broadcast; a worker keeps its coder beside it."""
    with open(path or public_tokenizers.path(MODEL), "rb") as file:
        sent = spark.sparkContext.broadcast({"model": file.read()})

    def make() -> PieceBpe:
        if "coder" not in sent.value:
            sent.value["coder"] = PieceBpe(sent.value["model"], check)
        return sent.value["coder"]

    return make


def piece_digests(docs: DataFrame, path: str | None = None, check: bool = True) -> DataFrame:
    """Encode and decode every whole text of ``docs`` (doc_id, text); one row for each row.

    NULL text counts as empty: no ids, digests of the empty string. NULL ids and repeated rows are rows like others; an
    empty table gives an empty result; extra columns are ignored. Returns doc_id, n_tokens, ids_sha256 (decimal ids joined
    by commas), decoded_sha256 (the decoded text in UTF-8), n_bytes (its bytes), agrees: whether the library gives the same ids for each
    word of the text (no merge reaches over words, and a worker gives a word that it has met to the library once, until it forgets it), and the
    ids decode to the text, the mark as a space; NULL without ``check``. A worker's memory is some 100 bytes for each character of the longest stretch without a
    place where no piece reaches over.
    """
    make = _coder(docs.sparkSession, path, check)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = make()
        for batch in batches:
            out = []
            texts = batch.column(1).to_pylist()
            for text, (n, decimals, back) in zip(texts, coder.coded_all(texts), strict=True):
                agrees = back == text.replace(MARK, " ").encode() if check else None
                out.append([n, hashlib.sha256(decimals.encode()).hexdigest(), hashlib.sha256(back).hexdigest(), len(back), agrees])
            coder.compare()
            if coder.differs:
                for row, text in zip(out, batch.column(1), strict=True):
                    row[-1] &= not any(w in coder.differs for words in coder.words(text.as_py()) for w in words)
            columns = zip(*out, strict=True) if out else ((),) * 5
            kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_bytes", "agrees"],
            )

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string, n_bytes long, agrees boolean"
    return docs.select("doc_id", text_of().alias("text")).mapInArrow(digests, schema)


def piece_encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``docs`` (doc_id, text) as doc_id, ids array<int>."""
    make = _coder(docs.sparkSession, path)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = make()
        for batch in batches:
            ids = list(coder.encode_all(batch.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>"
    return docs.select("doc_id", text_of().alias("text")).mapInArrow(encode, schema)


def piece_decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids array<int>) back to doc_id, text; NULL ids give the empty text. Ids outside the vocabulary fail."""
    make = _coder(encoded.sparkSession, path)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = make()
        for batch in batches:
            out = [coder.decode(x.as_py() or []).decode() for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["doc_id", "text"])

    schema = f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, text string"
    return encoded.select("doc_id", "ids").mapInArrow(decode, schema)
