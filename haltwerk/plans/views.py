"""The stored tables and the delay table under fixed names, for SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..functions import ADDED, ARRIVAL, CANCELLED, DEPARTURE, STOP
from ..schemas import CHANGED_KEY, DIM_STATIONS, FACT_CHANGED, FACT_MESSAGES, FACT_PLANNED, MESSAGE_KEY
from ..sinks import appended_sql, history_sql, whole_sql
from .delay import SERVICE_DAY


def _time(column: str) -> str:
    """``packed_time`` in SQL."""
    x = f"try_cast({column} AS BIGINT)"
    parts = [f"{x} div {below} % 100" for below in (100_000_000, 1_000_000, 10_000, 100)]
    return f"CASE WHEN {x} BETWEEN 0 AND 9999999999 THEN try_make_timestamp_ntz({parts[0]} + 2000, {', '.join(parts[1:])}, {x} % 100, 0) END"


def _side(side: str) -> str:
    fields = ("PlannedTime", "PlannedPlatform", "IsReplaced", "ReplacementType")
    return f"named_struct('EventType', '{side}', {', '.join(f"'{f}', {side}_{f}" for f in fields)})"


#: ``delay_fact`` over the views of its two tables.
DELAY_SQL = f"""
WITH sides AS (
    SELECT EVA_Number, EventId, TrainName, TrainType, {SERVICE_DAY}, inline(array({_side(ARRIVAL)}, {_side(DEPARTURE)}))
    FROM fact_plannedtimetable),
active AS (SELECT * FROM fact_changedtimetable WHERE IsActive AND EventType <> '{STOP}'),
baseline AS (
    SELECT EVA_Number, EventId, TrainName, TrainType, EventType, {_time("PlannedTime")} AS PlannedTime, PlannedPlatform, IsReplaced, ReplacementType, {SERVICE_DAY}
    FROM sides WHERE {_time("PlannedTime")} IS NOT NULL
    UNION ALL
    SELECT CAST(eva_number AS STRING), EventId, TrainName, CAST(NULL AS STRING), EventType, {_time("ChangedTime")}, ChangedPlatform,
        CAST(NULL AS STRING), CAST(NULL AS STRING), {SERVICE_DAY}
    FROM active WHERE IsUnplannedEvent),
overlay AS (
    SELECT EventId, EventType, EventStatus, CancellationTime, ChangedPlatform, {_time("ChangedTime")} AS ChangedTime, {SERVICE_DAY}
    FROM active WHERE NOT IsUnplannedEvent)
SELECT b.EVA_Number, b.EventId, b.TrainName, b.TrainType, b.EventType, o.CancellationTime,
    coalesce(o.ChangedPlatform, b.PlannedPlatform) AS ActualPlatform, coalesce(o.ChangedTime, b.PlannedTime) AS ActualTime,
    b.PlannedTime, b.PlannedPlatform, b.IsReplaced, b.ReplacementType,
    CASE WHEN o.ChangedTime IS NOT NULL THEN CAST(CAST(o.ChangedTime - b.PlannedTime AS INTERVAL MINUTE) AS BIGINT) ELSE 0L END AS DelayMinutes,
    coalesce(o.EventStatus = '{CANCELLED}', false) AS IsCancelled, b.{SERVICE_DAY}
FROM baseline b LEFT JOIN overlay o ON o.EventId = b.EventId AND o.EventType = b.EventType AND o.{SERVICE_DAY} = b.{SERVICE_DAY}
"""


def register_views(spark: SparkSession, stations: str, planned: str, changed: str, messages: str, guard_late: bool = False) -> None:
    """Temporary views over the tables at these paths.

    A view is the text of a query over its path: each use finds the files that are there then, whoever wrote them, a
    stream's micro-batch or another process included. The facts and the delay table have the column ServiceDay: a filter on it limits
    what is read. ``guard_late`` as in ``read_history``. Tables without rows get an empty file that holds their columns.
    """
    views = {
        "dim_stations": whole_sql(spark, stations, DIM_STATIONS),
        "fact_plannedtimetable": appended_sql(spark, planned, FACT_PLANNED, SERVICE_DAY),
        "fact_changedtimetable": history_sql(spark, changed, FACT_CHANGED, CHANGED_KEY, SERVICE_DAY, guard_late=guard_late),
        "fact_messages": history_sql(spark, messages, FACT_MESSAGES, MESSAGE_KEY, SERVICE_DAY, guard_late=guard_late),
        "v_traindelayfact": DELAY_SQL,
    }
    for name, text in views.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} AS {text}")
