from .delay import SERVICE_DAY, added_events, delay_fact, latest_overlay, planned_events
from .kpi import ON_TIME_MINUTES, kpi_cancellation, kpi_ontime, kpi_ontime_by_station, kpi_ontime_by_station_asof, kpi_overview
from .loads import (
    MIN_MAIN_STATIONS,
    collected_at,
    full_change_rows,
    full_message_rows,
    load_full,
    load_full_changes,
    load_full_messages,
    load_planned,
    load_recent_changes,
    load_recent_messages,
    load_stations,
    planned_rows,
    recent_change_rows,
    recent_message_rows,
)
from .views import register_views

__all__ = [
    "MIN_MAIN_STATIONS", "ON_TIME_MINUTES", "SERVICE_DAY",
    "added_events", "collected_at", "delay_fact", "full_change_rows", "full_message_rows",
    "kpi_cancellation", "kpi_ontime", "kpi_ontime_by_station", "kpi_ontime_by_station_asof", "kpi_overview", "latest_overlay", "load_full", "load_full_changes",
    "load_full_messages", "load_planned", "load_recent_changes", "load_recent_messages", "load_stations",
    "planned_events", "planned_rows", "recent_change_rows", "recent_message_rows",
    "register_views",
]
