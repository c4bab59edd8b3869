"""Station dimension: cleaning, as-of selection, request work lists."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import day_key

# Fixed values.
OPEN_END = date(9999, 12, 31)
MAIN_STATION_SUFFIX = "Hbf"


def clean_stations(raw: DataFrame, run_date: date, open_end: date = OPEN_END) -> DataFrame:
    """Typed station rows, valid from ``run_date`` on."""
    return raw.select(
        F.col("_eva").try_cast("long").alias("eva_number"),
        F.col("_ds100").alias("ds100_code"),
        F.col("_name").alias("station_name"),
        F.col("_meta").alias("meta_stations"),
        F.col("_db").try_cast("boolean").alias("is_db_station"),
        F.col("_creationts").alias("creation_timestamp"),
        F.lit(run_date).alias("ValidFrom"),
        F.lit(open_end).alias("ValidTo"),
    )


def valid_asof(dim: DataFrame, day: date, suffix: str | None = None) -> DataFrame:
    """Rows valid on ``day`` (start included, end excluded), by name suffix if given."""
    rows = dim.where((F.col("ValidFrom") <= F.lit(day)) & (F.col("ValidTo") > F.lit(day)))
    return rows.where(F.col("station_name").endswith(suffix)) if suffix else rows


def open_main_stations(open_end: date = OPEN_END, suffix: str = MAIN_STATION_SUFFIX):
    """Aggregate that counts open main stations; the publishing guard checks it."""
    return F.count_if(F.col("station_name").endswith(suffix) & (F.col("ValidTo") == F.lit(open_end)))


def worklist(stations: DataFrame, day: date, hours: int = 24) -> DataFrame:
    """One request per station and hour of ``day``."""
    return stations.select(
        "eva_number",
        day_key(F.lit(day)).alias("day_key"),
        F.explode(F.sequence(F.lit(0), F.lit(hours - 1))).alias("h"),
    ).select("eva_number", "day_key", F.lpad(F.col("h").cast("string"), 2, "0").alias("hour"))
