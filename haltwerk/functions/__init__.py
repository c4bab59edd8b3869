from .flags import (
    ADDED,
    ARRIVAL,
    CANCELLED,
    DEPARTURE,
    STOP,
    cancelled_flag,
    replaced_flag,
    replacement_word,
    unplanned_flag,
)
from .times import (
    batch_name,
    day_key,
    delay_minutes,
    minutes_between,
    pack_time,
    packed_time,
    service_day,
)

__all__ = [
    "ADDED", "ARRIVAL", "CANCELLED", "DEPARTURE", "STOP",
    "batch_name", "cancelled_flag", "day_key", "delay_minutes", "minutes_between",
    "pack_time", "packed_time", "replaced_flag", "replacement_word", "service_day", "unplanned_flag",
]
