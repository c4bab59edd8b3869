"""I-Match fingerprints: terms of middling document frequency, hashed under several random lexicon subsets."""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import staged, text_of

#: The band: share of all documents that hold the term. LOW bounds the lexicon: (distinct terms of a mean document) / LOW.
LOW, HIGH = 0.002, 0.2
#: Random subsets of the lexicon: the share of terms that each keeps. Most are sparse, so that texts of which a part differs agree on some.
KEPT = (1.0, *(2.0**-i for i in range(1, 4) for _ in range(2)), *(2.0**-i for i in range(4, 10) for _ in range(6)))
#: Bits of the filter of terms that may be in the band; its size does not grow with the data.
FILTER_BITS = 22
#: Distinct terms that a task counts before it hands the counts on.
COUNTED = 400_000
#: UTF-8 bytes of texts in one range of ids.
RANGE_BYTES = 32 << 20


def _terms(text: str) -> set[str]:
    return set(text.lower().split())


def _cells(terms: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(t) for t in terms), np.uint64, len(terms)) >> np.uint64(64 - FILTER_BITS)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Counter, int]]:
    counts, n = Counter(), 0
    for batch in batches:
        for text in batch.column(0):
            counts.update(_terms(text.as_py()))
            n += 1
            if len(counts) >= COUNTED:
                yield counts, n
                counts, n = Counter(), 0
    if n:
        yield counts, n


def lexicon(texts: DataFrame, low: float = LOW, high: float = HIGH) -> tuple[list[str], int]:
    """(terms of the band in order, number of documents) over all of the one column ``text``.

    A term that is frequent overall is as frequent in some part of the documents. A first pass marks what is
    frequent in its part in a filter of fixed size; a second counts the marked terms over all documents.
    """
    spark = texts.sparkSession

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for counts, n in _counted(batches):
            often = np.unique(_cells([t for t, c in counts.items() if c >= low * n])).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(often), pa.array(np.zeros(len(often), np.int64))], names=["cell", "n"])
            yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([n], pa.int64())], names=["cell", "n"])

    marked = texts.mapInArrow(marks, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    cells, sums = marked["cell"].to_numpy(), marked["n"].to_numpy()
    n_docs = int(sums[cells < 0].sum())
    bits = np.zeros(1 << FILTER_BITS, bool)
    bits[cells[cells >= 0]] = True
    sent = spark.sparkContext.broadcast(np.packbits(bits))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = np.unpackbits(sent.value).astype(bool)
        for counts, _ in _counted(batches):
            terms = list(counts)
            keep = np.flatnonzero(marked[_cells(terms).astype(np.int64)])
            yield pa.RecordBatch.from_arrays(
                [pa.array([terms[i] for i in keep], pa.string()), pa.array([counts[terms[i]] for i in keep], pa.int64())], names=["term", "n"]
            )

    found = texts.mapInArrow(count, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = found.where((F.col("n") >= low * n_docs) & (F.col("n") <= high * n_docs)).select("term").toArrow()
    return sorted(found["term"].to_pylist()), n_docs


class Fingerprints:
    """Fingerprints of texts under one lexicon."""

    def __init__(self, terms: list[str]):
        self._index = {t: i for i, t in enumerate(terms)}
        self._known = frozenset(terms)
        self._hash, self._in = self._drawn(terms)

    @staticmethod
    def _drawn(terms: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the terms, and which subsets hold each."""
        hashes = np.fromiter((xxhash.xxh64_intdigest(t) for t in terms), np.uint64, len(terms))
        inside = np.ones((len(terms), len(KEPT)), bool)
        for k, share in enumerate(KEPT):
            if share < 1:
                # The subset's own random number of each term.
                x = hashes ^ np.uint64(0x9E3779B97F4A7C15 * (k + 1) & (1 << 64) - 1)
                x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
                x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
                inside[:, k] = (x >> np.uint64(11)).astype(np.float64) < share * 2.0**53
        return hashes, inside

    def of(self, text: str) -> list[str]:
        """One hash for each subset, empty if the text has no term of it. Without any term of the lexicon, all its terms count."""
        terms = _terms(text)
        known = terms & self._known
        if known:
            at = np.array(sorted(map(self._index.__getitem__, known)))
            hashes, inside = self._hash[at], self._in[at]
        else:
            hashes, inside = self._drawn(sorted(terms))
        return [xxhash.xxh32_hexdigest(hashes[inside[:, k]].tobytes()) if n else "" for k, n in enumerate(inside.sum(axis=0))]


def likeness(a: list[str], b: list[str]) -> float:
    """Share of the subsets, of those that hold a term of either text, under which both have one hash; 1 if none does."""
    used = [(x, y) for x, y in zip(a, b, strict=True) if x or y]
    return sum(x == y for x, y in used) / len(used) if used else 1.0


def _ranges(ids: DataFrame, n: int) -> np.ndarray:
    """The largest id of each of about ``n`` ranges of ids, in descending order: 8 bytes for each RANGE_BYTES of text."""

    def largest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = max((max(b.column(0).to_pylist()) for b in batches if b.num_rows), default=None)
        if top is not None:
            yield pa.RecordBatch.from_arrays([pa.array([top], pa.int64())], names=["id"])

    found = ids.repartitionByRange(n, F.col("id").desc()).mapInArrow(largest, "id long").toArrow()
    return np.sort(found["id"].to_numpy())[::-1].copy()


def fingerprint_edits(docs: DataFrame, low: float = LOW, high: float = HIGH) -> DataFrame:
    """Fingerprint every row of ``docs`` (doc_id, text), its edited text, and compare with the next row's.

    The next row is that with the next smaller doc_id, after the last the first; NULL ids come last, rows with one doc_id by
    the hash of their text. Edited text: the last floor(n / 2) code points of a text with n give way to the first as many (or all) of the next. NULL
    and empty texts have no terms; two without terms are alike (1.0). One row alone is its own next. An empty table gives an
    empty result; extra columns are ignored. Rows are dealt once, to ranges of ids; each range also gets the first row
    of the one after it. Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    """
    spark = docs.sparkSession
    first_id = -(1 << 63)
    rows = docs.select("doc_id", text_of().alias("text"))
    rows = rows.withColumn("id", F.coalesce(F.col("doc_id").cast("long"), F.lit(first_id)))
    terms, _ = lexicon(rows.select("text"), low, high)
    ids = staged(rows.select("id", F.octet_length("text").cast("long").alias("b")), "imatch-ids")
    total = ids.agg(F.sum("b")).head()[0] or 0
    tops = _ranges(ids.select("id"), 1 + total // RANGE_BYTES)
    sent_tops, sent_terms = spark.sparkContext.broadcast(tops), spark.sparkContext.broadcast(terms)

    @pandas_udf("int")
    def range_of(id: pd.Series) -> pd.Series:  # noqa: A002
        rising = sent_tops.value[::-1]
        return pd.Series((len(rising) - 1 - np.searchsorted(rising, id.to_numpy(), side="left")).astype(np.int32))

    order = F.xxhash64("text")
    own = rows.select(range_of("id").alias("range"), F.lit(0).alias("after"), "id", "doc_id", order.alias("h"), "text")
    heads = spark.createDataFrame([(int(x), (i - 1) % len(tops)) for i, x in enumerate(tops)], "id long, to int")
    # 12 bytes for each RANGE_BYTES of text, as the ranges themselves.
    heads = rows.join(F.broadcast(heads), "id").groupBy("id", "to").agg(F.min_by(F.struct("doc_id", "text"), order).alias("first"))
    heads = heads.select(F.col("to").alias("range"), F.lit(1).alias("after"), "id", "first.doc_id", F.lit(0).cast("long").alias("h"), "first.text")
    # A range is a task: hashing a few range numbers would put several into one.
    dealt = own.union(heads).repartitionById(max(1, len(tops)), "range").sortWithinPartitions("range", "after", F.desc("id"), "h")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints = Fingerprints(sent_terms.value)
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        spelt = lambda p: "".join(x or "-" * 8 for x in p)
        held = None
        for batch in batches:
            out = []
            for after, doc_id, text in zip(batch.column(0), batch.column(1), batch.column(2), strict=True):
                text = text.as_py()
                here = prints.of(text)
                if held:
                    before, old, mark = held
                    half = len(old) // 2
                    edited = old[: len(old) - half] + text[:half]
                    new = prints.of(edited)
                    digest = hashlib.sha256(edited.encode()).hexdigest()
                    out.append((before, len(old), digest, spelt(mark), spelt(new), likeness(mark, new), likeness(mark, here)))
                held = None if after.as_py() else (doc_id.as_py(), text, here)
            columns = zip(*out, strict=True) if out else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return dealt.select("after", F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(compare, schema)

