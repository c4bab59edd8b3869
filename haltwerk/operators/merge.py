"""Merging a batch into a table, DataFrame in and DataFrame out.

Keys match by SQL equality, so NULL never matches, unless ``null_safe`` is set. No side
is broadcast by hint: Spark broadcasts a key set only when its measured size is below
``spark.sql.autoBroadcastJoinThreshold`` and shuffles otherwise. Key sets are made
distinct first, which also reduces hot keys inside each map task; the other side of each
join is the preserved one, which adaptive execution can split when it is skewed.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_HIT = "__hit"
_NEWEST = "__newest"


def _join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, null_safe: bool = False) -> DataFrame:
    """Join on ``keys``, keeping only the left key columns."""
    if not null_safe:
        return left.join(right, list(keys), how)
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    same = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys))
    joined = left.join(renamed, same, how)
    return joined.drop(*(f"__r_{k}" for k in keys))


def _key_set(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).distinct()


def new_rows(target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Source rows whose key the target does not have.

    The target's keys are first reduced to those the batch asks for, so a small batch
    never makes a large target shuffle.
    """
    known = _join(target.select(*keys), _key_set(source, keys), keys, "left_semi", null_safe).distinct()
    return _join(source, known, keys, "left_anti", null_safe)


def merge_insert_only(target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Add rows with unknown keys; known rows are never changed."""
    return target.unionByName(new_rows(target, source, keys, null_safe))


def scd2_interval(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    run_date: date,
    open_end: date,
    reopen: bool = False,
    null_safe: bool = False,
    end: str = "ValidTo",
) -> DataFrame:
    """History by validity dates.

    Open rows missing from the source end at ``run_date``; source rows with an unknown
    key are added. A key that was closed earlier stays closed unless ``reopen`` is set.
    Rows already closed are passed on without a join.
    """
    still_open = F.col(end).eqNullSafe(F.lit(open_end))
    open_rows = target.where(still_open)
    hits = _key_set(source, keys).withColumn(_HIT, F.lit(True))
    ended = (
        _join(open_rows, hits, keys, "left", null_safe)
        .withColumn(end, F.when(F.col(_HIT).isNull(), F.lit(run_date)).otherwise(F.col(end)))
        .select(*target.columns)
    )
    inserts = new_rows(open_rows if reopen else target, source, keys, null_safe)
    return target.where(~still_open).unionByName(ended).unionByName(inserts)


def _switch_off(
    active: DataFrame, source: DataFrame, keys: Sequence[str], flag: str, null_safe: bool, newer_than: str | None
) -> DataFrame:
    if newer_than:
        hits = source.groupBy(*keys).agg(F.lit(True).alias(_HIT), F.max(newer_than).alias(_NEWEST))
        # An undated row gives way to a dated one, never the other way round.
        off = F.col(_HIT) & F.coalesce(F.col(_NEWEST) >= F.col(newer_than), F.col(newer_than).isNull())
    else:
        hits = _key_set(source, keys).withColumn(_HIT, F.lit(True))
        off = F.col(_HIT)
    joined = _join(active, hits, keys, "left", null_safe)
    return joined.withColumn(flag, ~F.coalesce(off, F.lit(False))).select(*active.columns)


def deactivate(
    target: DataFrame, source: DataFrame, keys: Sequence[str], flag: str = "IsActive", null_safe: bool = False
) -> DataFrame:
    """Clear the flag of active rows whose key is in the source.

    Inactive rows pass through untouched, so the growing part of a history is neither
    shuffled nor sorted.
    """
    active = F.col(flag).eqNullSafe(F.lit(True))
    return target.where(~active).unionByName(_switch_off(target.where(active), source, keys, flag, null_safe, None))


def flag_changes(
    active: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    flag: str = "IsActive",
    guard_late: bool = False,
    null_safe: bool = False,
    snapshot: str = "SnapshotTimestamp",
) -> DataFrame:
    """The rows an upsert has to write: all formerly active rows, and the batch.

    By default the batch always wins. With ``guard_late`` a batch row older than the
    active one is added as inactive and the active row stays.
    """
    kept = _switch_off(active, source, keys, flag, null_safe, snapshot if guard_late else None)
    if guard_late:
        current = _join(active, _key_set(source, keys), keys, "left_semi", null_safe)
        newest = current.groupBy(*keys).agg(F.max(snapshot).alias(_NEWEST))
        undated = F.col(_NEWEST).isNotNull() & F.col(snapshot).isNull()
        late = F.coalesce(F.col(_NEWEST) > F.col(snapshot), undated)
        source = _join(source, newest, keys, "left", null_safe).withColumn(flag, ~late)
    return kept.unionByName(source.select(*active.columns))


def scd2_flag_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    flag: str = "IsActive",
    guard_late: bool = False,
    null_safe: bool = False,
) -> DataFrame:
    """History by active flag: earlier versions off, the batch added as active.

    ``source`` holds one row per key (see ``latest_snapshot``).
    """
    active = F.col(flag).eqNullSafe(F.lit(True))
    changed = flag_changes(target.where(active), source, keys, flag, guard_late, null_safe)
    return target.where(~active).unionByName(changed)
