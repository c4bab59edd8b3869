"""Measures on the delay table; each is one partial and one final aggregation."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.asof import join_asof
from ..operators.dedup import dedup_first
from ..operators.stations import valid_asof

# Assumed default: no formula is published.
ON_TIME_MINUTES = 5


def kpi_cancellation(fact: DataFrame, by: Sequence[str]) -> DataFrame:
    """Share of cancelled events."""
    return fact.groupBy(*by).agg(
        F.count("*").alias("n_events"),
        F.count_if("IsCancelled").alias("n_cancelled"),
        F.avg(F.col("IsCancelled").cast("double")).alias("cancellation_rate"),
    )


def kpi_ontime(fact: DataFrame, by: Sequence[str], threshold: int = ON_TIME_MINUTES) -> DataFrame:
    """Share of events on time, cancelled events and events of unknown delay left out."""
    on_time = F.col("DelayMinutes") <= threshold
    return (
        fact.where(~F.col("IsCancelled") & F.col("DelayMinutes").isNotNull())
        .groupBy(*by)
        .agg(
            F.count("*").alias("n_events"),
            F.count_if(on_time).alias("n_on_time"),
            F.avg(on_time.cast("double")).alias("on_time_share"),
        )
    )


def kpi_ontime_by_station(
    fact: DataFrame, stations: DataFrame, day: date, threshold: int = ON_TIME_MINUTES
) -> DataFrame:
    """On-time share per station with its name on ``day``; aggregates before it joins."""
    shares = kpi_ontime(fact, ["EVA_Number"], threshold)
    names = dedup_first(
        valid_asof(stations, day).select(
            F.col("eva_number").cast("string").alias("EVA_Number"), "station_name", "ValidFrom"
        ),
        ["EVA_Number"],
        [F.col("ValidFrom").desc()],
    ).drop("ValidFrom")
    return shares.join(names, "EVA_Number", "left")


def kpi_ontime_by_station_asof(fact: DataFrame, stations: DataFrame, threshold: int = ON_TIME_MINUTES) -> DataFrame:
    """On-time share per station and the name it had on the planned day of each event.

    Events are summed by station and day first, so what meets the versions is at most one row for each of these.
    """
    days = kpi_ontime(fact.withColumn("Day", F.to_date("PlannedTime")), ["EVA_Number", "Day"], threshold)
    versions = stations.select(F.col("eva_number").cast("string").alias("EVA_Number"), "station_name", "ValidFrom", "ValidTo")
    named = join_asof(days, versions, "EVA_Number", "Day", ["station_name"])
    shares = named.groupBy("EVA_Number", "station_name").agg(F.sum("n_events").alias("n_events"), F.sum("n_on_time").alias("n_on_time"))
    return shares.withColumn("on_time_share", F.col("n_on_time") / F.col("n_events"))


def kpi_overview(fact: DataFrame, threshold: int = ON_TIME_MINUTES) -> DataFrame:
    """Cancellations and on-time shares by train type, by station, by planned day and in all: one pass, one shuffle.

    ``level`` names the grouping; the other groupings' columns are NULL. Partial sums of all levels are made before the shuffle.
    """
    timed = ~F.col("IsCancelled") & F.col("DelayMinutes").isNotNull()
    levels = ["TrainType", "EVA_Number", "Day"]
    narrow = fact.select("TrainType", "EVA_Number", F.to_date("PlannedTime").alias("Day"), "IsCancelled", "DelayMinutes")
    sums = narrow.groupingSets([[c] for c in levels] + [[]], *levels).agg(
        F.grouping_id().alias("__id"),
        F.count("*").alias("n_events"),
        F.count_if("IsCancelled").alias("n_cancelled"),
        F.count_if(timed).alias("n_timed"),
        F.count_if(timed & (F.col("DelayMinutes") <= threshold)).alias("n_on_time"),
    )
    level = F.element_at(F.create_map(*(F.lit(x) for x in (3, "type", 5, "station", 6, "day", 7, "all"))), F.col("__id").cast("int"))
    return sums.select(
        level.alias("level"),
        *levels,
        "n_events",
        "n_cancelled",
        (F.col("n_cancelled") / F.col("n_events")).alias("cancellation_rate"),
        "n_timed",
        "n_on_time",
        F.when(F.col("n_timed") > 0, F.col("n_on_time") / F.col("n_timed")).alias("on_time_share"),
    )
