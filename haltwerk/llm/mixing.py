"""Mixing sources to target weights with a low-discrepancy schedule."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, n_words, row_key, staged, text_of

#: Words in a block; the schedule has one slot for each block the mix takes.
BLOCK_WORDS = 8192
#: Slots that are ranked together; bounds the task of one window over the schedule.
CHUNK = 65_536
#: Cells of [0, 1) under which the sources' stretches are listed.
CELLS = 4096
#: The golden ratio's fraction in units of 2**-62: points are exact to the last bit of a double, however many there are.
UNIT = 1 << 62
GOLDEN = (math.isqrt(5 * UNIT * UNIT) - UNIT) // 2


def source_targets(sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Words to take from each source: ``sizes`` has (source, source_size), one row for each source.

    Sources in code-point order, NULL last, weigh ``weights`` in turn and share ``share`` of all words.
    A target stops at ``most`` times its source and the excess goes to the others by weight, until
    none is above; that is one water level, found by running sums over the sources ordered by
    the level at which each is full. Returns source, source_size, weight, target, whole_target.
    """
    named = Window.orderBy(F.isnull("source"), "source")
    turn = F.array(*[F.lit(float(w)) for w in weights])
    t = sizes.withColumn("weight", F.element_at(turn, (F.pmod(F.row_number().over(named) - 1, F.lit(len(weights))) + 1).cast("int")))
    t = t.select("*", (F.lit(most) * F.col("source_size")).alias("full"))
    full_at = Window.orderBy(F.col("full") / F.col("weight"), F.isnull("source"), "source")
    before, after = full_at.rowsBetween(Window.unboundedPreceding, -1), full_at.rowsBetween(0, Window.unboundedFollowing)
    everything = full_at.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # The level if exactly the sources before this one are full; the first that holds it is right.
    t = t.withColumn(
        "level",
        (F.lit(share) * F.sum("source_size").over(everything) - F.coalesce(F.sum("full").over(before), F.lit(0.0))) / F.sum("weight").over(after),
    )
    t = t.withColumn("level", F.first(F.when(F.col("level") * F.col("weight") <= F.col("full"), F.col("level")), True).over(everything))
    t = t.withColumn("target", F.coalesce(F.least(F.col("full"), F.col("level") * F.col("weight")), F.col("full")))
    return t.select("source", "source_size", "weight", "target", F.floor("target").cast("long").alias("whole_target"))


def _laid_out(docs: DataFrame, seed: str) -> DataFrame:
    """Every row's place on the line of words of its source, in an order shuffled by MD5 of ``seed`` and doc_id.

    Totals of ranges of the order give offsets, so a source with a third of all rows is summed by many tasks.
    """
    rows = docs.select("doc_id", F.col("source").cast("string").alias("source"), n_words().alias("size"), row_key("doc_id", "text").alias("row"))
    rows = rows.withColumn("o", F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))
    rows = rows.withColumn("range", F.substring("o", 1, 3))
    ranges = rows.groupBy("source", "range").agg(F.sum("size").alias("words"))
    ahead = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("source", "range", F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("source", "range").orderBy("o", "doc_id", "size")
    rows = rows.select(
        "doc_id",
        "row",
        "source",
        "size",
        "range",
        F.row_number().over(inside).alias("nth"),
        (F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")).alias("begin"),
    )
    same = rows["source"].eqNullSafe(ranges["source"]) & (rows["range"] == ranges["range"])
    return rows.join(ranges, same).select(rows["doc_id"], "row", rows["source"], "size", rows["range"], "nth", (F.col("begin") + F.col("offset")).alias("begin"))


def _spare(points: float) -> float:
    """More than an interval can lack of its share of so many golden-ratio points."""
    return 2 * math.log(points + 2) + 3


def _stretches(plan: DataFrame, block_words: int) -> tuple[DataFrame, int]:
    """(source, blocks, low, high): each source's stretch of [0, 1); and how many points give all of them their blocks.

    A stretch is as wide as the source's words, but that a source of few blocks gets as much as it needs for these and ``_spare`` points more:
    with its true width it could ask for very many points for the sake of one block.
    """
    need = plan.where("whole_target > 0").select("source", F.ceil(F.col("whole_target") / F.lit(block_words)).alias("blocks"), F.col("whole_target").cast("double").alias("words"))
    blocks, sources = need.agg(F.coalesce(F.sum("blocks"), F.lit(0)), F.count("*")).head()
    spare = _spare(2 * blocks + 100 * sources)
    few = F.col("blocks") < 2 * spare
    few_blocks, n_few, words = need.agg(F.coalesce(F.sum(F.when(few, F.col("blocks"))), F.lit(0)), F.count_if(few), F.coalesce(F.sum(F.when(~few, F.col("words"))), F.lit(1.0))).head()
    least = blocks + spare * n_few
    width = F.when(few, (F.col("blocks") + F.lit(spare)) / F.lit(float(least or 1))).otherwise(F.col("words") / F.lit(words) * F.lit((blocks - few_blocks) / (least or 1)))
    by = Window.orderBy(F.isnull("source"), "source")
    need = need.withColumn("high", F.sum(width).over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    need = need.withColumn("low", F.coalesce(F.lag("high").over(by), F.lit(0.0)))
    # What a source of width d needs: n * d - discrepancy(n) >= blocks.
    n = need.agg(F.max((F.col("blocks") + F.lit(spare)) / (F.col("high") - F.col("low")))).head()[0]
    return need.select("source", "blocks", "low", "high"), math.ceil(n or 0) + 1


def _slots(plan: DataFrame, block_words: int) -> DataFrame:
    """(slot, source, rank): golden-ratio points mapped through cumulative weights, ranked within their source.

    ``plan`` has one row for each source. A point falls to the source whose stretch of [0, 1) holds it. Points behind a source's last block
    go unused, and every source is checked to have all its slots.
    """
    spark = plan.sparkSession
    need, n = _stretches(plan, block_words)
    whole = lambda c: c.cast("decimal(19,0)")
    turned = F.pmod(whole(F.col("id") + 1) * whole(F.lit(GOLDEN)), whole(F.lit(UNIT))).cast("double") / float(UNIT)
    points = spark.range(n).select(F.col("id").alias("slot"), turned.alias("x"))
    # Each stretch is listed under the cells of [0, 1) that it meets, so points find theirs by an equi-join.
    cell = lambda x: F.least(F.floor(x * CELLS), F.lit(CELLS - 1))
    stretches = need.withColumn("cell", F.explode(F.sequence(cell(F.col("low")), cell(F.col("high")))))
    points = points.withColumn("cell", cell(F.col("x"))).join(stretches, "cell").where("low <= x AND x < high")
    points = points.select("slot", "source", "blocks", F.expr(f"slot div {CHUNK}").alias("chunk"))
    counts = points.groupBy("source", "chunk").agg(F.count("*").alias("n")).withColumnRenamed("source", "of").withColumnRenamed("chunk", "in")
    ahead = Window.partitionBy("of").orderBy("in").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("of", "in", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("offset"))
    nth = F.row_number().over(Window.partitionBy("source", "chunk").orderBy("slot"))
    ranked = points.withColumn("nth", nth).join(counts, F.col("source").eqNullSafe(F.col("of")) & (F.col("chunk") == F.col("in")))
    ranked = staged(ranked.withColumn("rank", (F.col("nth") - 1 + F.col("offset")).cast("long")).where("rank < blocks").select("slot", "source", "rank"), "mix-slots")
    got = ranked.groupBy(F.col("source").alias("of")).agg(F.count("*").alias("got"))
    short = need.join(got, F.col("source").eqNullSafe(F.col("of")), "left").where(F.coalesce("got", F.lit(0)) != F.col("blocks"))
    if found := short.head():
        raise RuntimeError(f"source {found.source!r} has {found.got} of {found.blocks} slots")
    return ranked


def mix_schedule(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0, block_words: int = BLOCK_WORDS, seed: str = "mix") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, targets, pieces) of a mix of ``docs`` (doc_id, text, source).

    rows: doc_id, row (its key), source, size, range, nth, begin: a row and its place. targets: see ``source_targets``.
    pieces: slot, source, range, nth, pass, from, to: words [from, to) of the row, to be read in
    slot ``slot``. Blocks of ``block_words`` of a source's shuffled line are read in the order of its
    slots, the line again from its start when it ends; the last slot stops at the target.
    """
    rows = staged(_laid_out(docs, seed), "mix-rows")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = staged(source_targets(sizes, weights, share, most), "mix-targets")
    slots = _slots(targets, block_words)
    # A block of the line as it is read, its words counted on over all passes.
    taken = slots.join(targets, slots["source"].eqNullSafe(targets["source"])).select(
        "slot",
        slots["source"].alias("source"),
        (F.col("rank") * block_words).alias("read_from"),
        F.least((F.col("rank") + 1) * block_words, F.col("whole_target")).alias("read_to"),
        "source_size",
    )
    # A block that runs over the end of the line goes on at its start: one part for each pass.
    taken = taken.withColumn("pass", F.explode(F.sequence(F.expr("read_from div source_size"), F.expr("(read_to - 1) div source_size"))))
    base = F.col("pass") * F.col("source_size")
    taken = taken.select(
        "slot",
        "source",
        "pass",
        F.greatest(F.col("read_from") - base, F.lit(0)).alias("lo"),
        F.least(F.col("read_to") - base, F.col("source_size")).alias("hi"),
    )
    cut = lambda lo, hi: F.explode(F.sequence(F.expr(f"{lo} div {block_words}"), F.expr(f"({hi} - 1) div {block_words}")))
    taken = taken.withColumn("block", cut("lo", "hi"))
    parts = rows.where("size > 0").withColumn("block", cut("begin", "(begin + size)")).withColumnRenamed("source", "of")
    both = (taken["block"] == parts["block"]) & taken["source"].eqNullSafe(parts["of"])
    low, high = F.lit(block_words) * parts["block"], F.lit(block_words) * (parts["block"] + 1)
    pieces = taken.join(parts, both).select(
        "slot",
        "source",
        "range",
        "nth",
        "pass",
        (F.greatest("lo", "begin", low) - F.col("begin")).alias("from"),
        (F.least("hi", F.col("begin") + F.col("size"), high) - F.col("begin")).alias("to"),
    )
    return rows, targets, pieces.where("to > from")


def mix_sources(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0, block_words: int = BLOCK_WORDS, seed: str = "mix") -> DataFrame:
    """Words that the mix takes of every row of ``docs`` (doc_id, text, source).

    NULL or empty text: size 0, nothing taken. NULL source: a source of its own, last in order. Repeated rows and
    NULL ids are rows of their own. A table without words takes nothing; an empty table gives an empty result.
    Extra columns are ignored. Taken words of a source add up to its target, rounded down; a row is
    taken at most ``most`` times. Returns doc_id, source, size, source_size,
    target, taken, range, nth, first_slot and n_slots: where the schedule reads the row first (NULL: nowhere), and in how many slots.
    """
    rows, targets, pieces = mix_schedule(docs, weights, share, most, block_words, seed)
    sums = pieces.groupBy(F.col("source").alias("s"), F.col("range").alias("r"), F.col("nth").alias("k")).agg(
        F.sum(F.col("to") - F.col("from")).alias("words"), F.min("slot").alias("first_slot"), F.count_distinct("slot").alias("n_slots")
    )
    same = F.col("source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r")) & (F.col("nth") == F.col("k"))
    out = rows.join(sums, same, "left").withColumn("taken", F.coalesce("words", F.lit(0)).cast("long"))
    targets = targets.select(F.col("source").alias("of"), "source_size", "target")
    return out.join(targets, F.col("source").eqNullSafe(F.col("of"))).select("doc_id", "source", "size", "source_size", "target", "taken", "range", "nth", "first_slot", F.coalesce("n_slots", F.lit(0)).alias("n_slots"))


def mixed_documents(docs: DataFrame, slot: str | None = None, **options) -> DataFrame:
    """The rows of the mix with the columns of ``docs`` (doc_id, text, source and any others): a row for each time it is read.

    Sorted by ``slot``, the name of a further column that holds where the schedule begins to read the row, they are in mixed order.

    A row that is read in part, where its source's target ends, has these words and the white space between; ``n_chars``, if
    there is such a column, follows. Rows of which nothing is taken, such as empty texts, are not in the mix. Options are those of ``mix_schedule``.
    """
    rows, _, pieces = mix_schedule(docs, **options)
    reads = pieces.groupBy(F.col("source").alias("s"), F.col("range").alias("r"), F.col("nth").alias("k"), "pass").agg(F.min("from").alias("from"), F.max("to").alias("to"), F.min("slot").alias("slot"))
    same = F.col("source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r")) & (F.col("nth") == F.col("k"))
    reads = rows.join(reads, same).select("row", "from", "to", "slot", (F.col("to") - F.col("from") == F.col("size")).alias("whole"))
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), row_key("doc_id", "text").alias("row")).dropDuplicates(["row"])
    words = F.regexp_extract_all(text_of("doc.text"), F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    part = F.array_join(F.slice(words, (F.col("from") + 1).cast("int"), (F.col("to") - F.col("from")).cast("int")), "")
    read = held.join(reads, "row").withColumn("read", F.when(F.col("whole"), F.col("doc.text")).otherwise(part))
    new = {"text": F.col("read"), "n_chars": F.char_length("read").cast("long")}
    shown = [new.get(c, F.col(f"doc.`{c}`")).cast(docs.schema[c].dataType).alias(c) for c in docs.columns]
    return read.select(*shown, *([F.col("slot").alias(slot)] if slot else []))
