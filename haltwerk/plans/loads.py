"""The six loads: raw records in, stored tables out.

Every load takes its raw DataFrame and the path of its table. Full and recent loads share
their steps; only the record shape and the source of the snapshot time differ. The
``*_rows`` functions are the pure part.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import (
    MAIN_STATION_SUFFIX,
    OPEN_END,
    clean_stations,
    first_planned,
    flatten_planned,
    latest_snapshot,
    open_main_stations,
    require_nonempty,
    scd2_interval,
    stop_events,
    stop_messages,
)
from ..schemas import CHANGED_KEY, DIM_STATIONS, MESSAGE_KEY, PLANNED_KEY, STATION_KEY
from ..sinks import append_new, publish, read_whole, upsert_history

# Fixed value.
MIN_MAIN_STATIONS = 130


def collected_at() -> Column:
    """Snapshot time of a JSON record."""
    return F.col("_collected_at").try_cast("timestamp")


def planned_rows(stops: DataFrame) -> DataFrame:
    return first_planned(flatten_planned(stops))


def full_change_rows(stops: DataFrame, batch_ts) -> DataFrame:
    """Latest change per key of XML stop records, all stamped with one batch time."""
    return latest_snapshot(stop_events(stops, F.lit(batch_ts), distinct_stops=False), CHANGED_KEY)


def recent_change_rows(stops: DataFrame) -> DataFrame:
    """Latest change per key of JSON stop records."""
    return latest_snapshot(stop_events(stops, collected_at(), "", distinct_stops=False), CHANGED_KEY)


def full_message_rows(stops: DataFrame, batch_ts) -> DataFrame:
    return latest_snapshot(stop_messages(stops, F.lit(batch_ts)), MESSAGE_KEY)


def recent_message_rows(stops: DataFrame) -> DataFrame:
    return latest_snapshot(stop_messages(stops, collected_at(), "", json_text=True), MESSAGE_KEY)


def load_stations(
    raw: DataFrame,
    path: str,
    run_date: date,
    min_main_stations: int = MIN_MAIN_STATIONS,
    suffix: str = MAIN_STATION_SUFFIX,
    batch: str | None = None,
) -> bool:
    """Merge a full station list into the dimension; a list with too few open main
    stations afterwards is not committed. The list is parsed once."""
    current = read_whole(raw.sparkSession, path, DIM_STATIONS)
    cleaned = clean_stations(raw, run_date).persist()
    try:
        merged = scd2_interval(current, cleaned, STATION_KEY, run_date, OPEN_END)
        return publish(merged, path, open_main_stations(suffix=suffix), min_main_stations, batch)
    finally:
        cleaned.unpersist()


def load_planned(stops: DataFrame, path: str, batch: str | None = None) -> bool:
    """Add plan rows of events not seen before."""
    return append_new(planned_rows(stops), path, PLANNED_KEY, batch)


def load_full_changes(stops: DataFrame, path: str, batch_ts, batch: str | None = None) -> bool:
    return upsert_history(full_change_rows(stops, batch_ts), path, batch=batch)


def load_recent_changes(stops: DataFrame, path: str, batch: str | None = None) -> bool:
    rows = recent_change_rows(require_nonempty(stops, "recent changes"))
    return upsert_history(rows, path, batch=batch)


def load_full_messages(stops: DataFrame, path: str, batch_ts, batch: str | None = None) -> bool:
    return upsert_history(full_message_rows(stops, batch_ts), path, batch=batch)


def load_recent_messages(stops: DataFrame, path: str, batch: str | None = None) -> bool:
    return upsert_history(recent_message_rows(stops), path, batch=batch)


def load_full(stops: DataFrame, changes: str, messages: str, batch_ts, batch: str | None = None) -> tuple[bool, bool]:
    """Changes and messages of one file of XML stop records, parsed once."""
    stops = stops.persist()
    try:
        return load_full_changes(stops, changes, batch_ts, batch), load_full_messages(stops, messages, batch_ts, batch)
    finally:
        stops.unpersist()
