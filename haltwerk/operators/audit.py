"""Checks on incoming batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def require_nonempty(df: DataFrame, what: str = "batch") -> DataFrame:
    """Pass ``df`` on, or fail if it has no rows (stops at the first row found)."""
    if df.isEmpty():
        raise ValueError(f"{what}: no records found")
    return df


def batch_profile(df: DataFrame, path: str, recursive: bool = False) -> DataFrame:
    """Files, bytes and records of ``df``, which was read from ``path`` (a folder, file or pattern), in one row.

    Sizes come from a table of the files that Spark lists; no content is read for them. That table leaves empty files out, so their
    number is that of the listing which reading ``df`` has made. Records are counted by the scan.
    """
    files = df.sparkSession.read.format("binaryFile").option("recursiveFileLookup", recursive).load(path).select("length")
    n_files = F.lit(len(df.inputFiles())).cast("long").alias("n_files")
    sizes = files.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("n_bytes")).select(n_files, "n_bytes")
    # One row on either side.
    return sizes.join(df.agg(F.count("*").alias("n_records")), F.lit(True)).select("n_files", "n_bytes", "n_records")


def null_audit(df: DataFrame, column: str) -> DataFrame:
    """Rows whose audit column is NULL."""
    return df.where(F.col(column).isNull())


def find_event(df: DataFrame, event_id: str) -> DataFrame:
    """All rows of one event."""
    return df.where(F.col("EventId") == event_id)
