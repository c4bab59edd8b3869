"""Tables in plain Parquet folders.

A fact is appended to: a batch writes ``<path>/data/part=<day>/batch=<name>`` and nothing else, so
its cost is its own rows, and batches of several writers under different names never touch
each other. Every row carries the time its load began (``LoadOrder``). What is active is found on
read: of the rows of one key the one loaded last, or, where late data has to be guarded against, the one with
the newest snapshot time. A batch becomes visible when Spark's job commit moves its folders into place; before that,
also after a lost attempt, its rows lie in a staging folder. Then a small file below ``<path>/done`` notes its name, and a
replay is skipped. A retry under the same name replaces the batch's folders.

A dimension is replaced as a whole: ``<path>/data/snapshot_id=<n>`` is written, checked, and becomes
current with its commit record. One writer; a lost attempt's folder is overwritten by the next.
"""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import service_day
from ..operators.merge import new_rows

_ORDER = "LoadOrder"
_LAYOUT = [T.StructField(_ORDER, T.LongType()), T.StructField("part", T.StringType()), T.StructField("batch", T.StringType())]
_COMMIT = T.StructType([T.StructField("snapshot_id", T.LongType())])
_CREATED = "table created"
#: Number of the empty snapshot, and part and batch of the empty batch, that hold the columns of a table without rows.
_SEED = -1
_SEED_PART = "none"


def _empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows; the optimizer drops whatever is joined or united with it."""
    return spark.range(1).limit(0).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields))


def _read_or_empty(spark: SparkSession, path: str, schema: T.StructType, kind: str, **options: str) -> DataFrame:
    try:
        return spark.read.schema(schema).options(**options).format(kind).load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return _empty(spark, schema)


# batches that are done -------------------------------------------------------------------


def _note(path: str, batch: str) -> str:
    return f"{path}/done/{hashlib.sha256(batch.encode()).hexdigest()}"


def batch_committed(spark: SparkSession, path: str, batch: str) -> bool:
    """Whether a batch of this name is done. Looks at its own note only, however many there are."""
    return not _read_or_empty(spark, _note(path, batch), T.StructType([T.StructField("batch", T.StringType())]), "json").isEmpty()


def _mark_done(spark: SparkSession, path: str, batch: str) -> None:
    spark.range(0, 1, 1, 1).select(F.lit(batch).alias("batch")).write.mode("overwrite").json(_note(path, batch))


# whole snapshots -----------------------------------------------------------------------


def current_snapshot(spark: SparkSession, path: str) -> int | None:
    """Number of the newest committed snapshot, or None."""
    n = _read_or_empty(spark, f"{path}/commits", _COMMIT, "json").agg(F.max("snapshot_id").alias("n")).first()["n"]
    return None if n == _SEED else n


def publish(
    df: DataFrame,
    path: str,
    check: Column | None = None,
    min_value: int = 0,
    batch: str | None = None,
) -> bool:
    """Write ``df`` as the next whole snapshot; commit it only if it passes the check.

    ``check`` is an aggregate over the written rows (the input is not computed twice).
    Returns whether the snapshot was committed; if not, the previous one stays current. A batch
    that is done is skipped.
    """
    spark = df.sparkSession
    if batch is not None and batch_committed(spark, path, batch):
        return False
    current = current_snapshot(spark, path)
    n = 0 if current is None else current + 1
    target = f"{path}/data/snapshot_id={n}"
    df.write.mode("overwrite").parquet(target)
    if check is not None:
        value = spark.read.schema(df.schema).parquet(target).agg(check.alias("v")).first()["v"]
        if value is None or value < min_value:
            return False
    # One partition, one file: all or nothing.
    spark.range(0, 1, 1, 1).select(F.lit(n).cast("long").alias("snapshot_id")).write.mode("append").json(f"{path}/commits")
    if batch is not None:
        _mark_done(spark, path, batch)
    return True


def read_whole(spark: SparkSession, path: str, schema: T.StructType, snapshot: int | None = None) -> DataFrame:
    """A whole table at ``snapshot`` (default: newest). Reads only that snapshot's folder."""
    n = current_snapshot(spark, path) if snapshot is None else snapshot
    if n is None:
        return _empty(spark, schema)
    return spark.read.schema(schema).parquet(f"{path}/data/snapshot_id={n}")


def whole_sql(spark: SparkSession, path: str, schema: T.StructType) -> str:
    """Text of a query of the newest snapshot; it finds it, and the files, each time it runs. The table gets an empty snapshot first."""
    seed = spark.range(0, 1, 1, 1).select(F.lit(_SEED).cast("long").alias("snapshot_id"))
    _empty(spark, schema).write.mode("ignore").parquet(f"{path}/data/snapshot_id={_SEED}")
    if _read_or_empty(spark, f"{path}/commits", _COMMIT, "json").isEmpty():
        seed.write.mode("append").json(f"{path}/commits")
    newest = f"SELECT max(snapshot_id) FROM json.{_quoted(f'{path}/commits')}"
    return f"SELECT {', '.join(map(_quoted, schema.names))} FROM parquet.{_quoted(f'{path}/data')} WHERE snapshot_id = ({newest})"


def guarded_publish(candidate: DataFrame, previous: DataFrame, check: Column, min_value: int) -> DataFrame:
    """The candidate if it passes the check, else the previous table (nothing is written)."""
    value = candidate.agg(check.alias("v")).first()["v"]
    return candidate if value is not None and value >= min_value else previous


# appended batches ------------------------------------------------------------------------


def _stored(spark: SparkSession, path: str, schema: T.StructType, days: Sequence[str] | None = None) -> DataFrame:
    """All rows with their layout columns; with ``days`` only the folders of these days are listed."""
    full = T.StructType([*schema.fields, *_LAYOUT])
    if days is not None and not days:
        return _empty(spark, full)
    where = f"{path}/data" if days is None else f"{path}/data/part={{{','.join(days)}}}"
    return _read_or_empty(spark, where, full, "parquet", basePath=f"{path}/data")


def _write_batch(rows: DataFrame, path: str, batch: str, began: int, late: str | None = None) -> None:
    order = F.lit(began) if late is None else F.when(F.col(late), F.lit(0)).otherwise(F.lit(began))
    if rows.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
        # Right-sized files: small parts share a task, a big part is split into many.
        rows = rows.hint("rebalance", "part")
    # Added after the shuffle, which then does not carry the batch's name with every row.
    rows = rows.withColumns({_ORDER: order.cast("long"), "batch": F.lit(batch)})
    rows = rows.drop(late) if late else rows
    # Dynamic: only the batch's own folders are replaced, whatever the session's overwrite mode is.
    rows.write.partitionBy("part", "batch").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(f"{path}/data")
    _mark_done(rows.sparkSession, path, batch)


def _now() -> int:
    return time.time_ns() // 1000


def append_new(
    source: DataFrame,
    path: str,
    keys: Sequence[str],
    batch: str | None = None,
    part: Callable[[str], Column] = service_day,
) -> bool:
    """Insert-only merge into a stored table: only unknown rows are written.

    Known keys are looked up in the day parts of the batch only; their number is bounded by that of days.
    One writer for each day at a time: two that add the same unknown key both write it.
    """
    spark, began = source.sparkSession, _now()
    if batch is not None and batch_committed(spark, path, batch):
        return False
    batch = batch or uuid.uuid4().hex
    rows = source.withColumn("part", part("EventId")).persist()
    try:
        touched = [r["part"] for r in rows.select("part").distinct().collect()]
        known = _stored(spark, path, source.schema, touched).where(F.col("batch") != batch)
        _write_batch(new_rows(known, rows, keys), path, batch, began)
    finally:
        rows.unpersist()
    return True


def upsert_history(
    source: DataFrame,
    path: str,
    flag: str = "IsActive",
    batch: str | None = None,
    part: Callable[[str], Column] = service_day,
    late: str | None = None,
) -> bool:
    """Add a batch (one row per key) to a history. Writes the batch's rows, reads and rewrites nothing.

    A batch name that is done is skipped, so a replay changes nothing. ``part`` must depend on the key only and take
    a bounded number of values. Rows for which the column ``late`` holds are kept as if loaded before all others: they are never active
    beside a row of their key that is not late. The column is not stored.
    """
    spark, began = source.sparkSession, _now()
    if batch is not None and batch_committed(spark, path, batch):
        return False
    _write_batch(source.drop(flag).withColumn("part", part("EventId")), path, batch or uuid.uuid4().hex, began, **({"late": late} if late else {}))
    return True


def _shown(rows: DataFrame, schema: T.StructType, day: str | None) -> DataFrame:
    return rows.select(*schema.names, *([F.col("part").alias(day)] if day else []))


def read_appended(
    spark: SparkSession, path: str, schema: T.StructType, days: Sequence[str] | None = None, day: str | None = None
) -> DataFrame:
    """An insert-only table; ``days`` limits it, ``day`` names a column that shows the day part."""
    return _shown(_stored(spark, path, schema, days), schema, day)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _stored_sql(spark: SparkSession, path: str, schema: T.StructType) -> str:
    """A stored table as SQL names it. An empty batch makes sure that it has its columns, and that parts and batches are read as text."""
    held = T.StructType([*schema.fields, _LAYOUT[0]])
    _empty(spark, held).write.mode("ignore").parquet(f"{path}/data/part={_SEED_PART}/batch={_SEED_PART}")
    return f"parquet.{_quoted(f'{path}/data')}"


def appended_sql(spark: SparkSession, path: str, schema: T.StructType, day: str) -> str:
    """Text of a query like ``read_appended``; it lists the table each time it runs."""
    return f"SELECT {', '.join(map(_quoted, schema.names))}, part AS {_quoted(day)} FROM {_stored_sql(spark, path, schema)}"


def history_sql(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    keys: Sequence[str],
    day: str,
    flag: str = "IsActive",
    guard_late: bool = False,
    snapshot: str = "SnapshotTimestamp",
) -> str:
    """Text of a query like ``read_history``; it lists the table each time it runs."""
    table = _stored_sql(spark, path, T.StructType([f for f in schema.fields if f.name != flag]))
    newest = [f"{_quoted(snapshot)} DESC NULLS LAST"] * guard_late + [f"{_ORDER} DESC", "batch DESC"]
    place = f"row_number() OVER (PARTITION BY part, {', '.join(map(_quoted, keys))} ORDER BY {', '.join(newest)})"
    whole = " AND ".join(f"{_quoted(k)} IS NOT NULL" for k in keys)

    def rows(source: str, active: str) -> str:
        shown = ", ".join(f"{active} AS {_quoted(n)}" if n == flag else _quoted(n) for n in schema.names)
        return f"SELECT {shown}, part AS {_quoted(day)} FROM {source}"

    # The day gets its name above the window, so that a filter on it goes through.
    ranked = f"(SELECT *, {place} AS __rank FROM {table} WHERE {whole})"
    return f"{rows(ranked, '__rank = 1')} UNION ALL {rows(f'{table} WHERE NOT ({whole})', 'true')}"


def _ranked(rows: DataFrame, keys: Sequence[str], guard_late: bool, snapshot: str) -> tuple[DataFrame, DataFrame]:
    """(rows with a whole key and their rank, rows with a NULL in their key). NULL equals nothing, so the latter are all active."""
    newest = [F.col(_ORDER).desc(), F.col("batch").desc()]
    if guard_late:
        newest = [F.col(snapshot).desc_nulls_last(), *newest]
    whole = reduce(Column.__and__, (F.col(k).isNotNull() for k in keys))
    # The day follows from the key; in the window it lets a filter on days through to the scan.
    place = F.row_number().over(Window.partitionBy("part", *keys).orderBy(*newest))
    return rows.where(whole).withColumn("__rank", place), rows.where(~whole)


def _history(spark: SparkSession, path: str, schema: T.StructType, flag: str, days: Sequence[str] | None) -> DataFrame:
    return _stored(spark, path, T.StructType([f for f in schema.fields if f.name != flag]), days)


def read_active(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    keys: Sequence[str],
    flag: str = "IsActive",
    guard_late: bool = False,
    snapshot: str = "SnapshotTimestamp",
    days: Sequence[str] | None = None,
    day: str | None = None,
) -> DataFrame:
    """The active rows of a history: the first of each key, kept before the shuffle in every task."""
    ranked, loose = _ranked(_history(spark, path, schema, flag, days), keys, guard_late, snapshot)
    active = ranked.where(F.col("__rank") == 1).drop("__rank").unionByName(loose)
    return _shown(active.withColumn(flag, F.lit(True)), schema, day)


def read_history(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    keys: Sequence[str],
    flag: str = "IsActive",
    guard_late: bool = False,
    snapshot: str = "SnapshotTimestamp",
    days: Sequence[str] | None = None,
    day: str | None = None,
) -> DataFrame:
    """All versions, each with its flag.

    The row of a key that was loaded last is active; with ``guard_late`` the one with the newest
    snapshot time (a row without one gives way), of equal ones the one loaded last.
    """
    ranked, loose = _ranked(_history(spark, path, schema, flag, days), keys, guard_late, snapshot)
    rows = ranked.withColumn(flag, F.col("__rank") == 1).drop("__rank").unionByName(loose.withColumn(flag, F.lit(True)))
    return _shown(rows, schema, day)


# bootstrap -----------------------------------------------------------------------------------


def create_if_absent(spark: SparkSession, path: str, schema: T.StructType) -> bool:
    """Note that there is a table here, unless the path already holds one. No folder of data is written, so
    every reader of either kind of table gives no rows."""
    there = current_snapshot(spark, path) is not None or batch_committed(spark, path, _CREATED)
    if there or not _stored(spark, path, schema).isEmpty():
        return False
    _mark_done(spark, path, _CREATED)
    return True
