"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def dedup_first(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """First row per key under a total order.

    ``order`` decides; equal rows are settled by ``tiebreak`` (default: every other
    column, ascending, NULLs first), so the survivor does not depend on how the input
    was split. NULL keys form a group, as in any window.

    Spark limits each group to one row inside every map task before the shuffle
    (WindowGroupLimit), so a hot key costs one row per task and no more.
    """
    if tiebreak is None:
        tiebreak = [c for c in df.columns if c not in set(keys)]
    window = Window.partitionBy(*keys).orderBy(*order, *(F.col(c).asc_nulls_first() for c in tiebreak))
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)


def first_planned(planned: DataFrame) -> DataFrame:
    """First plan row per event by time; a row without any time comes first."""
    return dedup_first(
        planned,
        ["EventId"],
        [F.coalesce("Arrival_PlannedTime", "Departure_PlannedTime").asc_nulls_first()],
    )


def latest_snapshot(df: DataFrame, keys: Sequence[str], snapshot: str = "SnapshotTimestamp") -> DataFrame:
    """Newest row per key."""
    return dedup_first(df, keys, [F.col(snapshot).desc_nulls_last()])
