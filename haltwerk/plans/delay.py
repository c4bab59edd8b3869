"""The curated plan-versus-actual table at event grain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ARRIVAL, DEPARTURE, STOP, cancelled_flag, delay_minutes, packed_time
from ..operators.shred import unpivot_groups

_GROUPS = {
    side: {
        "PlannedTime": f"{side}_PlannedTime",
        "PlannedPlatform": f"{side}_PlannedPlatform",
        "IsReplaced": f"{side}_IsReplaced",
        "ReplacementType": f"{side}_ReplacementType",
    }
    for side in (ARRIVAL, DEPARTURE)
}
_EVENT = ["EventId", "EventType"]
#: The day part of stored tables, where their readers show it.
SERVICE_DAY = "ServiceDay"


def _day_of(df: DataFrame) -> list[str]:
    return [SERVICE_DAY] if SERVICE_DAY in df.columns else []


def planned_events(planned: DataFrame) -> DataFrame:
    """Planned arrivals and departures as rows, those with a time only."""
    rows = unpivot_groups(planned, _GROUPS, ["EVA_Number", "EventId", "TrainName", "TrainType", *_day_of(planned)])
    return rows.withColumn("PlannedTime", packed_time("PlannedTime")).where(F.col("PlannedTime").isNotNull())


def _active(changed: DataFrame, unplanned: bool) -> DataFrame:
    kind = F.col("IsUnplannedEvent") if unplanned else ~F.col("IsUnplannedEvent")
    return changed.where(F.col("IsActive") & kind & (F.col("EventType") != STOP))


def added_events(changed: DataFrame) -> DataFrame:
    """Active added events; their changed time and platform stand in for a plan."""
    nothing = F.lit(None).cast("string")
    return _active(changed, unplanned=True).select(
        F.col("eva_number").cast("string").alias("EVA_Number"),
        "EventId",
        "TrainName",
        nothing.alias("TrainType"),
        "EventType",
        packed_time("ChangedTime").alias("PlannedTime"),
        F.col("ChangedPlatform").alias("PlannedPlatform"),
        nothing.alias("IsReplaced"),
        nothing.alias("ReplacementType"),
        *_day_of(changed),
    )


def latest_overlay(changed: DataFrame) -> DataFrame:
    """Active changes of planned events."""
    return _active(changed, unplanned=False).select(
        *_EVENT, "EventStatus", "CancellationTime", "ChangedPlatform", packed_time("ChangedTime").alias("ChangedTime"), *_day_of(changed)
    )


def delay_fact(planned: DataFrame, changed: DataFrame, days: Sequence[str] | None = None, apart: bool = False) -> DataFrame:
    """Every planned or added event with its actual platform and time, delay and cancellation.

    If both tables show their day part, it is joined on (it follows from the event id) and kept, so a
    filter on it, or ``days``, limits what is read of both. With ``apart`` planned and added events meet the changes each on
    their own, which reads the changes once more, but lets two tables of ``store_bucketed`` join without a shuffle.
    """
    day = [c for c in _day_of(planned) if c in changed.columns]
    if not day:
        planned, changed = planned.drop(SERVICE_DAY), changed.drop(SERVICE_DAY)
    if days is not None:
        planned, changed = (t.where(F.col(SERVICE_DAY).isin(list(days))) for t in (planned, changed))
    baselines = [planned_events(planned), added_events(changed)]
    if not apart:
        baselines = [baselines[0].unionByName(baselines[1])]
    facts = [_overlaid(b, latest_overlay(changed), day) for b in baselines]
    return facts[0].unionByName(facts[1]) if apart else facts[0]


def _overlaid(baseline: DataFrame, overlay: DataFrame, day: list[str]) -> DataFrame:
    return baseline.join(overlay, [*_EVENT, *day], "left").select(
        "EVA_Number",
        "EventId",
        "TrainName",
        "TrainType",
        "EventType",
        "CancellationTime",
        F.coalesce("ChangedPlatform", "PlannedPlatform").alias("ActualPlatform"),
        F.coalesce("ChangedTime", "PlannedTime").alias("ActualTime"),
        "PlannedTime",
        "PlannedPlatform",
        "IsReplaced",
        "ReplacementType",
        delay_minutes("PlannedTime", "ChangedTime").alias("DelayMinutes"),
        cancelled_flag(F.col("EventStatus")).alias("IsCancelled"),
        *day,
    )
