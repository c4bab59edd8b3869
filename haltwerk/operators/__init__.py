from .asof import join_asof
from .audit import batch_profile, find_event, null_audit, require_nonempty
from .dedup import dedup_first, first_planned, latest_snapshot
from .merge import deactivate, flag_changes, merge_insert_only, new_rows, scd2_flag_upsert, scd2_interval
from .planned import flatten_planned, replacement_cols
from .shred import message_rejects, stop_events, stop_messages, unpivot_groups
from .stations import MAIN_STATION_SUFFIX, OPEN_END, clean_stations, open_main_stations, valid_asof, worklist

__all__ = [
    "MAIN_STATION_SUFFIX", "OPEN_END",
    "batch_profile", "clean_stations", "deactivate", "dedup_first", "find_event", "first_planned",
    "flag_changes", "flatten_planned", "join_asof", "latest_snapshot", "merge_insert_only", "message_rejects",
    "new_rows", "null_audit", "open_main_stations", "replacement_cols", "require_nonempty",
    "scd2_flag_upsert", "scd2_interval", "stop_events", "stop_messages", "unpivot_groups",
    "valid_asof", "worklist",
]
