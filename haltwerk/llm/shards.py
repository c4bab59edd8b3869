"""Shards of near equal bytes: a line of bytes cut by global prefix sums, around the large groups of equal texts. DataFrame functions only."""

from __future__ import annotations

import heapq
import json

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged, text_of

#: Leading bits of the order hash that make a range bucket; bounds the table of bucket totals.
BUCKET_BITS = 12
#: Cells into which the rows of one text are dealt, so that a hot text is no single task.
CELLS = 64


def _groups_dealt(sizes: list[tuple[int, int, int]], shards: int) -> tuple[list[dict], list[int]]:
    """Large groups (h, bytes, rows), the largest first, each to the shard that holds least; and the bytes of each shard then."""
    least = [(0, 0, i) for i in range(shards)]  # bytes, rows, shard
    dealt = []
    for h, size, n in sorted(sizes, key=lambda g: (-g[1], g[0])):
        held, rows, shard = heapq.heappop(least)
        dealt.append({"h": h, "large": shard, "ahead": rows})
        heapq.heappush(least, (held + size, rows + n, shard))
    return dealt, [held for held, _, _ in sorted(least, key=lambda x: x[2])]


def _bounds(rest: int, held: list[int]) -> list[int]:
    """Where each shard ends on the line of the other bytes: all shards are filled up to one level."""
    level, below = 0.0, 0
    for k, x in enumerate(sorted(held), 1):
        below += x
        level = (rest + below) / k
        if k == len(held) or level <= sorted(held)[k]:
            break
    ends, at = [], 0.0
    for x in held:
        at += max(0.0, level - x)
        ends.append(round(at))
    return ends


def shard_by_bytes(docs: DataFrame, shards: int = 24, overhead: int = 8, large: float = 0.02) -> DataFrame:
    """Deal every row of ``docs`` (doc_id, text) to one of ``shards`` shards of near equal bytes; equal texts stay together.

    Rows are laid out on one line by (hash of the text, cell, doc_id). Totals per range bucket give each bucket its offset, running sums
    inside a bucket give each cell its offset, and a running sum inside a cell gives each row its place; the line is
    cut into contiguous shards, each group of equal texts going where its middle lies. Groups that take more than ``large`` of a
    shard are not on the line: they are dealt as wholes, the largest first to the shard that holds least, and the line fills all shards up to one
    level. So shards differ by about ``large`` of one, more only where whole groups of near a shard's size do not add up evenly.
    A group larger than a shard cannot stay whole; it lies on the line and is cut by rows.
    The driver sees the large groups, at most ``shards / large`` (1,200), and one total.

    Size is the text's UTF-8 bytes plus ``overhead``. NULL and empty text: no bytes. NULL
    doc_id: a row like any other, ahead of the numbers in its cell. Repeated rows each get their own slot.
    An empty table gives an empty result. Extra columns are ignored. Returns doc_id, size,
    text_crc32, law, shard, slot, grown_shard.
    """
    spark, text = docs.sparkSession, text_of()
    rows = docs.select(
        F.col("doc_id"),
        (F.octet_length(text) + F.lit(overhead)).cast("long").alias("size"),
        F.crc32(text).cast("long").alias("text_crc32"),
        F.xxhash64(text).alias("h"),
    )
    rows = rows.select(
        "*",
        F.shiftrightunsigned("h", 64 - BUCKET_BITS).alias("bucket"),
        F.pmod(F.xxhash64("doc_id"), F.lit(CELLS)).alias("cell"),
    )
    cells = staged(rows.groupBy("bucket", "h", "cell").agg(F.sum("size").alias("b"), F.count("*").alias("n")), "shard-cells")
    total = cells.agg(F.sum("b")).head()[0] or 0
    groups = cells.groupBy("h").agg(F.sum("b").alias("b"), F.sum("n").alias("n"))
    fits = (F.col("b") * shards > F.lit(large * total)) & (F.col("b") * shards <= total)
    found = [tuple(r) for r in groups.where(fits).collect()]
    dealt, held = _groups_dealt(found, shards)
    ends = _bounds(total - sum(held), held)
    dealt = spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(dealt)), "array<struct<h: bigint, large: int, ahead: bigint>>")))

    ahead = (Window.unboundedPreceding, Window.currentRow)
    one_text, inside = Window.partitionBy("bucket", "h"), Window.partitionBy("bucket").orderBy("h", "cell").rowsBetween(*ahead)
    cells = cells.join(F.broadcast(dealt), "h", "left")
    on_line = lambda c: F.when(F.col("large").isNull(), F.col(c)).otherwise(0)
    cells = cells.withColumns({"line_b": on_line("b"), "line_n": on_line("n")})
    # At most 2 ** BUCKET_BITS rows reach this window.
    totals = cells.groupBy("bucket").agg(F.sum("line_b").alias("b"), F.sum("line_n").alias("n"))
    line = Window.orderBy("bucket").rowsBetween(*ahead)
    totals = totals.select("bucket", (F.sum("b").over(line) - F.col("b")).alias("bucket_b"), (F.sum("n").over(line) - F.col("n")).alias("bucket_n"))
    cells = cells.select(
        "bucket",
        "h",
        "cell",
        "large",
        (F.sum("line_b").over(inside) - F.col("line_b")).alias("cell_b"),
        (F.sum("line_n").over(inside) - F.col("line_n")).alias("cell_n"),
        (F.sum("n").over(one_text.orderBy("cell").rowsBetween(*ahead)) - F.col("n") + F.col("ahead")).alias("large_n"),
        F.sum("b").over(one_text).alias("text_b"),
    )
    cells = cells.withColumn("text_at", F.min("cell_b").over(one_text))
    cells = cells.join(totals, "bucket").select(
        "h",
        "cell",
        "large",
        "large_n",
        (F.col("cell_b") + F.col("bucket_b")).alias("cell_b"),
        (F.col("cell_n") + F.col("bucket_n")).alias("cell_n"),
        (F.col("text_at") + F.col("bucket_b")).alias("text_at"),
        "text_b",
        (F.col("text_b") * F.lit(shards) <= total).alias("whole"),
    )
    own = Window.partitionBy("h", "cell").orderBy("doc_id", "size", "text_crc32").rowsBetween(*ahead)
    nth = F.count(F.lit(1)).over(own) - 1
    # Twice the middle of what goes to one shard: the text, or the row.
    at2 = F.when(F.col("whole"), 2 * F.col("text_at") + F.col("text_b")).otherwise(2 * (F.col("cell_b") + F.sum("size").over(own)) - F.col("size"))
    placed = rows.join(cells, ["h", "cell"]).select(
        "doc_id",
        "size",
        "text_crc32",
        "large",
        at2.alias("at2"),
        F.when(F.col("large").isNull(), F.col("cell_n") + nth).alias("rank"),
        (F.col("large_n") + nth).alias("large_rank"),
    )
    passed = F.size(F.filter(F.array(*[F.lit(2 * x) for x in ends]), lambda x: x <= F.col("at2")))
    shard = F.coalesce("large", F.least(passed, F.lit(shards - 1)).cast("int"))
    placed = staged(placed.select("doc_id", "size", "text_crc32", "rank", "large_rank", shard.alias("shard")), "shards")
    # One row for each shard: its stretch of the line comes first, then its large groups.
    first = placed.groupBy("shard").agg(F.min("rank").alias("first"), F.count("rank").alias("n"))
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.coalesce(F.col("rank") - F.col("first"), F.col("n") + F.col("large_rank")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
