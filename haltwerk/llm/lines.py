"""Repeated runs of lines by winnowing over line hashes. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import row_key, staged, text_of

#: Words of the shortest run of lines that counts as repeated; also the reach of a window.
MIN_WORDS = 50
WORD = r"[^\x20\x09-\x0D]+"


def _lines(docs: DataFrame) -> DataFrame:
    """(d, row, n, at, h, words, before): the non-blank lines of each distinct row; ``n`` counts them, ``at`` all lines, ``before`` is the words ahead."""
    trimmed = F.transform(F.split(text_of(), "\n", -1), lambda x: F.btrim(x, F.lit(" \t\r\x0b\x0c")))
    rows = docs.select(F.col("doc_id").alias("d"), row_key("doc_id", "text").alias("row"), F.posexplode(trimmed).alias("at", "line")).where("line <> ''")
    rows = rows.select("d", "row", "at", F.xxhash64("line").alias("h"), F.regexp_count("line", F.lit(WORD)).cast("long").alias("words"))
    # Rows that are equal in id and text are one document here.
    rows = rows.groupBy("row", "at").agg(F.first("d").alias("d"), F.first("h").alias("h"), F.first("words").alias("words"))
    whole = Window.partitionBy("row").orderBy("at")
    return rows.select(
        "d",
        "row",
        "at",
        "h",
        "words",
        F.row_number().over(whole).alias("n"),
        (F.sum("words").over(whole.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("words")).alias("before"),
    )


def _windows(lines: DataFrame, min_words: int) -> DataFrame:
    """(d, row, n, to, h, print, key): the windows of each document, from line ``n`` to line ``to``.

    A window is a shortest run of lines with ``min_words`` words: one starts at each line, and one ends at each line, which is left out
    where it is one of the first kind. Every line of a run of ``min_words`` words is in a window that lies in the run. The fingerprint of
    a window is its longest line, of equal ones the one with the least hash, then the last (``h`` its hash, ``print`` its number). Fingerprint
    and ``key`` depend on the window's content alone.
    """
    least = F.min(F.struct((-F.col("words")).alias("longest"), "h", (-F.col("n")).alias("last")))
    ahead = Window.partitionBy("row").orderBy("before").rangeBetween(0, min_words - 1)
    back = Window.partitionBy("row").orderBy("after").rangeBetween(1 - min_words, 0)
    ends = lines.withColumn("after", F.col("before") + F.col("words"))
    held = F.max("after").over(ahead) - F.col("before")
    starting = ends.select("d", "row", "n", F.max("n").over(ahead).alias("to"), least.over(ahead).alias("least"), F.collect_list("h").over(ahead).alias("all"), held.alias("held"))
    held = F.col("after") - F.min("before").over(back)
    ending = ends.select("d", "row", F.min("n").over(back).alias("n"), F.col("n").alias("to"), least.over(back).alias("least"), F.collect_list("h").over(back).alias("all"), held.alias("held"), "words")
    ending = ending.where(F.col("held") - F.col("words") >= min_words).drop("words")
    windows = starting.where(F.col("held") >= min_words).unionByName(ending)
    key = F.struct(F.col("least.h").alias("line"), F.xxhash64("all").alias("whole")).alias("key")
    return windows.select("d", "row", "n", "to", F.col("least.h").alias("h"), (-F.col("least.last")).alias("print"), key)


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(row, at): the lines of ``docs`` (doc_id, text) that are in a run of at least ``min_words`` words which stands earlier too.

    Equal windows have equal fingerprints at different places, so windows whose fingerprint stands at one place only are out. The others are
    grouped by content; each is compared with the first place of its own content, by (doc_id, NULL last, row, line), and its lines go unless
    it stands there or shares lines with it.
    """
    lines = staged(_lines(docs), "lines")
    windows = staged(_windows(lines, min_words), "line-windows")
    point = F.struct("row", "print")
    again = windows.groupBy("h").agg(F.min(point).alias("one"), F.max(point).alias("other")).where("one < other").select("h")
    windows = windows.join(again, "h", "left_semi")
    place = F.struct(F.isnull("d").alias("unnamed"), "d", "row", "n", "to")
    first = windows.groupBy("key").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first < last").select("key", F.col("first.row").alias("of"), F.col("first.to").alias("of_to"))
    later = windows.join(first, "key").where((F.col("row") != F.col("of")) | (F.col("n") > F.col("of_to")))
    # A line is in a later window if one that starts at it or before it reaches it.
    marks = lines.select("row", "n", "at", F.lit(None).cast("int").alias("to")).union(later.select("row", "n", F.lit(None).cast("int"), "to"))
    reach = F.max("to").over(Window.partitionBy("row").orderBy("n"))
    return marks.withColumn("reach", reach).where("at IS NOT NULL AND reach >= n").select("row", "at")


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with its later repeated runs of lines deleted.

    Lines end at line feeds and are compared without white space at their ends; blank ones take no part and stay. The first
    document with a run, by doc_id (NULL last), keeps it; a run that repeats inside one document stays once, and where it
    overlaps itself, as ten equal lines do, its first ``min_words`` words or more stay. NULL and empty texts stay
    as they are (NULL gives an empty text). Rows equal in id and text are one document with one result each. Extra columns are
    ignored; an empty table gives no rows. Returns doc_id, text, n_lines, n_removed (lines), n_chars (of the text left).
    """
    gone = repeated_runs(docs, min_words).groupBy("row").agg(F.collect_set("at").alias("gone"))
    rows = docs.select("doc_id", text_of().alias("text"), row_key("doc_id", "text").alias("row"))
    all_lines = F.split("text", "\n", -1)
    last = F.size(all_lines) - 1
    kept = F.array_except(F.sequence(F.lit(0), last), "gone")
    left = F.array_join(F.transform(kept, lambda i: F.element_at(F.col("all"), i + 1)), "\n")
    out = rows.join(gone, "row", "left").withColumn("all", all_lines)
    out = out.select("doc_id", F.when(F.isnull("gone"), F.col("text")).otherwise(left).alias("text"), F.size("all").alias("n_lines"), F.when(F.isnull("gone"), 0).otherwise(F.size("gone")).alias("n_removed"))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
