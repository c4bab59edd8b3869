"""JSON Lines files, one record per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: microseconds survive a round trip.
_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def read_records_json(spark: SparkSession, pattern: str, schema: T.StructType) -> DataFrame:
    """All files matching ``pattern`` as one DataFrame; fails if no file matches."""
    return spark.read.schema(schema).option("timestampNTZFormat", _TIME_FORMAT).json(pattern)


def write_records_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("timestampNTZFormat", _TIME_FORMAT).json(path)


def archive_raw(df: DataFrame, path: str, batch: str, batch_ts=None) -> None:
    """Keep a raw batch below ``path`` in a partition named after it, with its time as a column.

    Only that partition is replaced, so archiving a batch twice leaves one copy, and batches of the
    same time do not touch each other. Without ``batch_ts`` the time is now.
    """
    time = F.current_timestamp() if batch_ts is None else F.lit(batch_ts)
    (
        df.withColumns({"archived_at": time.cast("timestamp"), "batch_id": F.lit(batch)})
        .write.partitionBy("batch_id")
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .parquet(path)
    )


def split_rejects(stops: DataFrame, id_field: str = "id") -> tuple[DataFrame, DataFrame]:
    """(records with an id, one row with the number of those without): lines that are no JSON, and records without id.

    Optional before a load; without it such a record becomes an active row without id.
    """
    missing = F.col(id_field).isNull()
    return stops.where(~missing), stops.where(missing).agg(F.count("*").alias("n_rejected"))
