"""Wall-clock times packed as yyMMddHHmm integers, and differences between them.

Packed times carry no zone, so they decode to TIMESTAMP_NTZ; results do not depend on
the session zone or on clock changes.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _digits(x: Column, below: int) -> Column:
    return F.call_function("div", x, F.lit(below)) % 100


def packed_time(c: Column | str) -> Column:
    """Decode ``yyMMddHHmm``; years 2000-2099; anything that is no time gives NULL.

    Pure integer arithmetic: a value that lost leading zeros (years 2000-2009) needs no
    padding and no text parser runs per row.
    """
    x = as_col(c).try_cast("long")
    return F.when(
        x.between(0, 9_999_999_999),
        F.try_make_timestamp_ntz(
            _digits(x, 100_000_000) + 2000,
            _digits(x, 1_000_000),
            _digits(x, 10_000),
            _digits(x, 100),
            x % 100,
            F.lit(0),
        ),
    )


def pack_time(c: Column | str) -> Column:
    """Encode a timestamp as a ``yyMMddHHmm`` long (seconds are cut off)."""
    t = as_col(c)
    packed = (F.year(t) % 100).cast("long")
    for part in (F.month(t), F.dayofmonth(t), F.hour(t), F.minute(t)):
        packed = packed * 100 + part
    return packed


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Whole minutes from start to end, cut towards zero, negative when end is earlier."""
    return (as_col(end) - as_col(start)).cast("interval minute").cast("long")


def delay_minutes(planned: Column | str, changed: Column | str) -> Column:
    """Delay where a changed time exists (NULL if there is no planned one), else 0."""
    return F.when(as_col(changed).isNotNull(), minutes_between(planned, changed)).otherwise(F.lit(0).cast("long"))


def day_key(day: Column | str) -> Column:
    return F.date_format(as_col(day), "yyMMdd")


def batch_name(ts: Column | str) -> Column:
    return F.date_format(as_col(ts), "yyyyMMdd_HHmmss")


def service_day(event_id: Column | str) -> Column:
    """Day part of an event id ``<trip>-<yyMMddHHmm>-<stop index>``; ``other`` if it has none.

    The same id always gives the same day, so history tables can be laid out by it. Only
    real dates count, which bounds the number of days.
    """
    start = F.regexp_extract(as_col(event_id), "-([0-9]{10})-[0-9]+$", 1)
    return F.when(packed_time(start).isNotNull(), F.substring(start, 1, 6)).otherwise("other")
