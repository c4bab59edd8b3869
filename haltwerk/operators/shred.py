"""Nested stop records to event rows and message rows; wide rows to long rows.

Each shredder reads its input once: a constant label array is exploded and every output
column picks its value by label. That stays in generated code (no lambdas), and because
single struct members are picked, Parquet reads only those members.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import ARRIVAL, DEPARTURE, STOP, unplanned_flag
from ..schemas import MESSAGES_JSON

_SIDES = {ARRIVAL: "ar", DEPARTURE: "dp"}
_LABEL = "EventType"


def _labels(*names: str) -> Column:
    return F.array(*(F.lit(n) for n in names))


def _by_label(values: Mapping[str, Column]) -> Column:
    picked = None
    for label, value in values.items():
        test = F.col(_LABEL) == label
        picked = F.when(test, value) if picked is None else picked.when(test, value)
    return picked


def _long(c: Column) -> Column:
    return c.try_cast("long")


def _event_columns(snapshot: Column, prefix: str) -> list[Column]:
    def pick(name: str) -> Column:
        return _by_label({label: F.col(f"{side}.{prefix}{name}") for label, side in _SIDES.items()})

    status = pick("cs")
    return [
        _long(F.col(f"{prefix}eva")).alias("eva_number"),
        F.col(f"{prefix}id").alias("EventId"),
        snapshot.alias("SnapshotTimestamp"),
        F.col(_LABEL),
        _long(pick("clt")).alias("CancellationTime"),
        pick("cp").alias("ChangedPlatform"),
        _long(pick("ct")).alias("ChangedTime"),
        pick("l").alias("TrainName"),
        status.alias("EventStatus"),
        unplanned_flag(status).alias("IsUnplannedEvent"),
        F.lit(True).alias("IsActive"),
    ]


def stop_events(
    stops: DataFrame, snapshot: Column, prefix: str = "_", distinct_stops: bool = True
) -> DataFrame:
    """One row per arrival and per departure; a stop with neither gives one ``Stop`` row.

    Only ``Stop`` rows are made distinct. A caller that keeps one row per key afterwards
    can pass ``distinct_stops=False`` and saves a second read and a shuffle.
    """
    columns = _event_columns(snapshot, prefix)
    has_ar, has_dp = F.col("ar").isNotNull(), F.col("dp").isNotNull()
    sides = (
        F.when(has_ar & has_dp, _labels(ARRIVAL, DEPARTURE)).when(has_ar, _labels(ARRIVAL)).when(has_dp, _labels(DEPARTURE))
    )

    def shred(df: DataFrame, labels: Column) -> DataFrame:
        return df.withColumn(_LABEL, F.explode(labels)).select(*columns)

    if not distinct_stops:
        return shred(stops, sides.otherwise(_labels(STOP)))
    bare = stops.where(~has_ar & ~has_dp)
    return shred(stops.where(has_ar | has_dp), sides).unionByName(shred(bare, _labels(STOP)).distinct())


_LISTS = {ARRIVAL: "ar.m", DEPARTURE: "dp.m", STOP: "m"}


def _list_of(label: str) -> str:
    return f"__{label}"


def _with_lists(stops: DataFrame) -> DataFrame:
    """A row for each message list of a stop, labelled, with the lists as columns of their own.

    Stops without any list are dropped by the scan, before the explode.
    """
    some = reduce(Column.__or__, (F.col(c).isNotNull() for c in _LISTS.values()))
    others = [c for c in stops.columns if c not in ("ar", "dp", "m")]
    flat = stops.where(some).select(*others, *(F.col(c).alias(_list_of(label)) for label, c in _LISTS.items()))
    labels = F.array(*(F.when(F.col(_list_of(label)).isNotNull(), F.lit(label)) for label in _LISTS))
    return flat.withColumn(_LABEL, F.explode(labels)).where(F.col(_LABEL).isNotNull())


def stop_messages(
    stops: DataFrame, snapshot: Column, prefix: str = "_", json_text: bool = False, seen: Observation | None = None
) -> DataFrame:
    """One row per message of the arrival, departure and stop lists.

    With ``json_text`` the lists arrive as JSON text: an array, or a single object that
    counts as a list of one. Text that does not parse gives no rows; ``message_rejects`` counts it, or ``seen``
    does, under the event types, while the messages are written.
    """
    present = _with_lists(stops)
    lists = _by_label({label: F.col(_list_of(label)) for label in _LISTS})
    msg = F.from_json(lists, MESSAGES_JSON) if json_text else lists
    at_stop = F.col(_LABEL) == STOP

    def part(name: str) -> Column:
        return F.col(f"__msg.{prefix}{name}")

    sent = _long(part("ts"))
    if seen:
        unread = (F.count_if((F.col(_LABEL) == label) & F.col("__list").isNull()).alias(label) for label in _LISTS)
        present, msg = present.withColumn("__list", msg).observe(seen, *unread), F.col("__list")
    rows = present.withColumn("__msg", F.explode(msg))
    return rows.select(
        _long(F.col(f"{prefix}eva")).alias("eva_number"),
        F.col(f"{prefix}id").alias("EventId"),
        F.col(_LABEL),
        snapshot.alias("SnapshotTimestamp"),
        part("id").alias("MessageId"),
        part("t").alias("MessageType"),
        sent.alias("MessageTime"),
        F.when(at_stop, part("cat")).alias("MessageCategory"),
        F.when(at_stop, _long(part("from"))).otherwise(sent).alias("MessageValidFrom"),
        F.when(at_stop, _long(part("to"))).otherwise(sent).alias("MessageValidTo"),
        F.lit(True).alias("IsActive"),
    )


def message_rejects(stops: DataFrame) -> DataFrame:
    """How many message texts per event type do not parse as JSON."""
    text = _by_label({label: F.col(_list_of(label)) for label in _LISTS})
    return (
        _with_lists(stops)
        .select(_LABEL, text.alias("text"))
        .where(F.from_json("text", MESSAGES_JSON).isNull())
        .groupBy(_LABEL)
        .agg(F.count("*").alias("n_rejected"))
    )


def unpivot_groups(
    df: DataFrame,
    groups: Mapping[str, Mapping[str, str]],
    keep: Sequence[str],
    drop_null: str | None = None,
) -> DataFrame:
    """Wide column groups to one row per group.

    ``groups`` maps a label to {output column: input column}; rows whose ``drop_null``
    output is NULL are left out.
    """
    outputs = list(next(iter(groups.values())))
    rows = df.withColumn(_LABEL, F.explode(_labels(*groups)))
    picked = {out: _by_label({label: F.col(cols[out]) for label, cols in groups.items()}) for out in outputs}
    long = rows.select(*keep, _LABEL, *(c.alias(out) for out, c in picked.items()))
    return long.where(F.col(drop_null).isNotNull()) if drop_null else long
