from .bucketed import store_bucketed
from .snapshots import (
    append_new,
    appended_sql,
    batch_committed,
    create_if_absent,
    current_snapshot,
    guarded_publish,
    history_sql,
    publish,
    read_active,
    read_appended,
    read_history,
    read_whole,
    upsert_history,
    whole_sql,
)

__all__ = [
    "append_new", "appended_sql", "batch_committed", "create_if_absent", "current_snapshot", "guarded_publish", "history_sql", "publish",
    "read_active", "read_appended", "read_history", "read_whole", "store_bucketed", "upsert_history", "whole_sql",
]
