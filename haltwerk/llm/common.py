"""Small helpers of the operators: null-safe text, word pattern, staged tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_dir

#: White space of the operators' word rule; a word is a run of anything else.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def text_of(column: str = "text") -> Column:
    """The text, NULL as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def n_words(column: str = "text") -> Column:
    """Number of words; 0 for NULL."""
    return F.regexp_count(text_of(column), F.lit(WORD)).cast("long")


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written below the shared folder and read again.

    Cuts the lineage: what follows reads files that survive a lost executor, and a
    result that is used twice is computed once.
    """
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key(*columns: str) -> Column:
    """Content key of a row: equal rows have equal keys, wherever they are read."""
    return F.xxhash64(*columns)


def keep_rows(docs: DataFrame, gone: DataFrame, once: DataFrame | None = None) -> DataFrame:
    """``docs`` (doc_id, text and any others) without the rows whose key is in ``gone``; of rows with a key in ``once`` one stays. Both have one column ``row``."""
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), row_key("doc_id", "text").alias("row"))
    if once is None or once.isEmpty():
        return held.join(gone, "row", "left_anti").select("doc.*")
    single = held.join(once, "row").dropDuplicates(["row"])
    return held.join(gone.union(once), "row", "left_anti").unionByName(single).select("doc.*")
