"""Exact duplicates: counting quotient filters find repeated fingerprints, bytes decide."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import keep_rows, row_key, staged, text_of

#: The leading bits of a 64-bit fingerprint name its block (the shuffle key); there are as many blocks as give one at most about
#: BLOCK_ROWS fingerprints, within these bounds. The rest is cut into quotient and remainder.
BLOCK_BITS = (6, 30)
BLOCK_ROWS = 1 << 20
#: Fingerprints that one filter takes before it is handed on; bounds a task's memory.
FILTER_ROWS = 2_000_000
#: Share of a filter's slots that are filled at most.
LOAD = 0.9
#: Repeated fingerprints (8 bytes each) that are broadcast; more are joined by a shuffle.
BROADCAST = 500_000
#: Copies of a repeated fingerprint in that shuffle; a hot one is read by as many tasks.
SALTS = 16

_FILTER = "block long, quotient_bits int, occupied binary, continued binary, shifted binary, remainders binary, many binary, counts binary"


def normalised(column: str = "text") -> Column:
    """The text without white space."""
    return F.translate(text_of(column), " \t\n\x0b\x0c\r", "")


class QuotientFilter:
    """A counting quotient filter of fingerprints of ``bits`` bits: exact, as quotient and remainder make up the whole fingerprint.

    A fingerprint's quotient is its home slot; the fingerprints of one quotient are a run of slots in the order of their remainders, which lies
    at home or is shifted behind the runs before it. Three bits of metadata a slot tell runs and homes apart: occupied (some fingerprint has
    this home), continued (the slot goes on with the run before), shifted (the slot is not its fingerprint's home). A slot without any is
    empty. Remainders are kept in whole bytes, and counters only for slots of more than one.
    """

    def __init__(self, bits: int, quotient_bits: int, occupied, continued, shifted, remainders, many, counts):
        self.bits, self.quotient_bits = bits, quotient_bits
        self.occupied, self.continued, self.shifted = occupied, continued, shifted
        self.remainders, self.many, self.counts = remainders, many, counts

    @classmethod
    def of(cls, found: np.ndarray, counts: np.ndarray, bits: int) -> QuotientFilter:
        """From distinct fingerprints in ascending order and their counts."""
        quotient_bits = min(bits, max(1, int(np.ceil(np.log2(max(1, len(found)) / LOAD)))))
        rest = np.uint64(bits - quotient_bits)
        home = (found >> rest).astype(np.int64)
        place = np.arange(len(found))
        slot = place + np.maximum.accumulate(home - place)  # the first free one from home on
        slots = max(1 << quotient_bits, int(slot[-1]) + 1 if len(slot) else 0)
        occupied, continued, shifted = (np.zeros(slots, bool) for _ in range(3))
        occupied[home] = True
        continued[slot] = np.r_[False, home[1:] == home[:-1]] if len(home) else False
        shifted[slot] = slot != home
        return cls(bits, quotient_bits, occupied, continued, shifted, found & ((np.uint64(1) << rest) - np.uint64(1)), counts > 1, counts[counts > 1])

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprints in ascending order and their counts, read back from slots and bits."""
        used = self.occupied | self.continued | self.shifted
        run = np.cumsum(~self.continued[used]) - 1  # the runs lie in the order of their homes
        home = np.flatnonzero(self.occupied)[run].astype(np.uint64)
        counts = np.ones(len(home), np.int64)
        counts[self.many] = self.counts
        return (home << np.uint64(self.bits - self.quotient_bits)) | self.remainders, counts

    def packed(self) -> tuple:
        width = -(-(self.bits - self.quotient_bits) // 8)
        remainders = self.remainders.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
        flags = (np.packbits(x).tobytes() for x in (self.occupied, self.continued, self.shifted))
        return (self.quotient_bits, *flags, remainders.tobytes(), np.packbits(self.many).tobytes(), self.counts.astype("<i8").tobytes())

    @classmethod
    def unpacked(cls, bits: int, quotient_bits: int, occupied: bytes, continued: bytes, shifted: bytes, remainders: bytes, many: bytes, counts: bytes) -> QuotientFilter:
        flags = [np.unpackbits(np.frombuffer(x, np.uint8)).astype(bool) for x in (occupied, continued, shifted)]
        n, width = int((flags[0] | flags[1] | flags[2]).sum()), -(-(bits - quotient_bits) // 8)
        held = np.zeros((n, 8), np.uint8)
        held[:, :width] = np.frombuffer(remainders, np.uint8).reshape(n, width)
        more = np.unpackbits(np.frombuffer(many, np.uint8))[:n].astype(bool)
        return cls(bits, quotient_bits, *flags, held.view("<u8").ravel(), more, np.frombuffer(counts, "<i8"))


def _builder(block_bits: int):
    """Fingerprints to filters, one for each block and so many rows."""
    rest = 64 - block_bits

    def filters(fingerprints: np.ndarray) -> pa.RecordBatch:
        found, counts = np.unique(fingerprints.view(np.uint64), return_counts=True)
        blocks, starts = np.unique(found >> np.uint64(rest), return_index=True)
        rows = []
        for block, a, b in zip(blocks.tolist(), starts, [*starts[1:], len(found)], strict=True):
            inside = found[a:b] & ((np.uint64(1) << np.uint64(rest)) - np.uint64(1))
            rows.append((block, *QuotientFilter.of(inside, counts[a:b], rest).packed()))
        kinds = [pa.int64(), pa.int32()] + [pa.binary()] * 6
        names = [x.split()[0] for x in _FILTER.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch.column(0).to_numpy(zero_copy_only=False))
            n += len(held[-1])
            if n >= FILTER_ROWS:
                yield filters(np.concatenate(held))
                held, n = [], 0
        if n:
            yield filters(np.concatenate(held))

    return build


def merged(filters: list[QuotientFilter]) -> QuotientFilter:
    """One filter of all: their sorted fingerprints are merged and counts added, so it equals the one built of all rows at once."""
    parts = [f.items() for f in filters]
    keys, counts = np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts])
    order = np.argsort(keys, kind="stable")  # merges runs that are sorted already
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return QuotientFilter.of(keys[starts], np.add.reduceat(counts, starts), filters[0].bits)


def _merger(block_bits: int):
    rest = 64 - block_bits

    def merge(rows: pa.Table) -> pa.Table:
        """Filters of one block; only fingerprints with counts above one leave."""
        block, *packed = (rows.column(i).to_pylist() for i in range(rows.num_columns))
        keys, counts = merged([QuotientFilter.unpacked(rest, *x) for x in zip(*packed, strict=True)]).items()
        whole = keys | (np.uint64(block[0]) << np.uint64(rest))
        return pa.table({"fp": whole[counts > 1].view(np.int64), "n": counts[counts > 1]})

    return merge


def repeated_fingerprints(fingerprints: DataFrame) -> DataFrame:
    """(fp, n) of every value of the one column ``fp`` that occurs more than once.

    Each task builds filters of its rows; the filters of a block, not the rows, are shuffled and
    merged without loss. A fingerprint that a third of all rows share is one entry per filter.
    """
    low, high = BLOCK_BITS
    bits = min(high, max(low, (fingerprints.count() // BLOCK_ROWS).bit_length()))
    built = fingerprints.select("fp").mapInArrow(_builder(bits), _FILTER)
    return built.groupBy("block").applyInArrow(_merger(bits), "fp long, n long")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """The class of equal normalised texts of every row of ``docs`` (doc_id, text).

    Rows whose fingerprint the merged filter counts once are alone. The others go, with their
    normalised bytes, to the join on the fingerprint, and are grouped by these bytes. Of each class the
    row with the most code points in the original text, then the smallest doc_id stays (NULL doc_id
    last); of repeated rows exactly one is kept. NULL text counts as empty, and
    empty texts are one class. Extra columns are ignored; an empty table gives an empty result.
    Returns doc_id, keep_id, group_size, kept, text_sha256, row (its key).
    """
    base = docs.select("doc_id", row_key("doc_id", "text").alias("row"), F.char_length(text_of()).cast("long").alias("n_chars"), normalised().alias("norm"))
    base = base.withColumn("fp", F.xxhash64("norm"))
    light = base.select("doc_id", "row", "n_chars", "fp", F.sha2("norm", 256).alias("text_sha256"))
    light = staged(light.withColumn("copy", F.row_number().over(Window.partitionBy("row").orderBy("fp"))), "exact-rows")

    suspects = staged(repeated_fingerprints(light), "exact-repeated").select("fp")
    if suspects.count() <= BROADCAST:
        routed = base.join(F.broadcast(suspects), "fp")
    else:
        salted = suspects.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        routed = base.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")).join(salted.hint("shuffle_merge"), ["fp", "salt"])
    best = F.min(F.struct((-F.col("n_chars")).alias("shorter"), F.isnull("doc_id").alias("unnamed"), F.col("doc_id").alias("id")))
    groups = routed.groupBy("fp", "norm").agg(F.count("*").alias("group_size"), best.alias("best")).where("group_size > 1")
    groups = groups.select(F.sha2("norm", 256).alias("text_sha256"), "group_size", "best")

    single = F.isnull("group_size")
    stays = (-F.col("best.shorter") == F.col("n_chars")) & F.col("best.id").eqNullSafe(F.col("doc_id")) & (F.col("copy") == 1)
    return light.join(groups, "text_sha256", "left").select(
        "doc_id",
        F.when(single, F.col("doc_id")).otherwise(F.col("best.id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (single | stays).alias("kept"),
        "text_sha256",
        "row",
    )


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text and any others) with the row of each class that stays."""
    found = staged(exact_duplicates(docs).select("row", "group_size", "kept"), "exact-kept").where("group_size > 1")
    rows = found.groupBy("row").agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
    return keep_rows(docs, rows.where("NOT kept").select("row"), rows.where("kept AND n > 1").select("row"))
