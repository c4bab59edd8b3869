from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from haltwerk.functions import (
    delay_minutes,
    minutes_between,
    pack_time,
    packed_time,
    replaced_flag,
    replacement_word,
    service_day,
    unplanned_flag,
)


def one(spark, col):
    return spark.range(1).select(col.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "packed, want",
    [
        (2407110541, datetime(2024, 7, 11, 5, 41)),
        (9912312359, datetime(2099, 12, 31, 23, 59)),
        (907110541, datetime(2009, 7, 11, 5, 41)),  # nine digits: year 2009 lost its zero
        (11110541, datetime(2000, 11, 11, 5, 41)),  # eight digits: year 2000
        (2402301200, None),  # 30 February
        (2407112460, None),
        (12407110541, None),  # eleven digits
        (-2407110541, None),
        (0, None),
        (None, None),
    ],
)
def test_packed_time(spark, packed, want):
    assert one(spark, packed_time(F.lit(packed).cast("long"))) == want


def test_packed_time_takes_text(spark):
    assert one(spark, packed_time(F.lit("2407110541"))) == datetime(2024, 7, 11, 5, 41)
    assert one(spark, packed_time(F.lit("soon"))) is None


def test_pack_time_is_the_inverse(spark):
    t = F.lit("2024-07-11 05:41:59").cast("timestamp_ntz")
    assert one(spark, pack_time(t)) == 2407110541
    assert one(spark, packed_time(pack_time(t))) == datetime(2024, 7, 11, 5, 41)


def test_clock_change_does_not_matter(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        assert one(spark, packed_time(F.lit(2403310230))) == datetime(2024, 3, 31, 2, 30)
        assert one(spark, minutes_between(packed_time(F.lit(2403310130)), packed_time(F.lit(2403310330)))) == 120
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@pytest.mark.parametrize(
    "planned, changed, want",
    [(2407110500, 2407110507, 7), (2407110500, 2407110455, -5), (2407110500, None, 0), (None, 2407110500, None), (None, None, 0)],
)
def test_delay(spark, planned, changed, want):
    def times(v):
        return packed_time(F.lit(v).cast("long"))

    assert one(spark, delay_minutes(times(planned), times(changed))) == want


def test_minutes_are_cut_towards_zero(spark):
    a, b = (F.lit(f"2024-07-11 05:00:{s}").cast("timestamp_ntz") for s in ("00", "59"))
    assert one(spark, minutes_between(a, b)) == 0
    assert one(spark, minutes_between(b, a)) == 0


@pytest.mark.parametrize(
    "booked, line, flag, kind, name",
    [
        ("ICE 7", None, "NO", None, None),
        ("ICE 7", "ICE 7", "NO", None, None),
        ("ICE 7", "RE 1", "YES", "ICE", "7"),
        ("ICE", "RE 1", "YES", "ICE", None),
        (None, "RE 1", "NO", None, None),
        (None, None, "NO", None, None),
    ],
)
def test_replacement(spark, booked, line, flag, kind, name):
    b, ln = F.lit(booked).cast("string"), F.lit(line).cast("string")
    assert one(spark, replaced_flag(b, ln)) == flag
    assert one(spark, replacement_word(b, ln, 0)) == kind
    assert one(spark, replacement_word(b, ln, 1)) == name


def test_unplanned(spark):
    assert [one(spark, unplanned_flag(F.lit(s).cast("string"))) for s in ("a", "c", None)] == [True, False, False]


def test_service_day(spark):
    ids = ["837-2607110541-100", "-837818-0007110541-1", "837-2613110541-1", "12", None]
    assert [one(spark, service_day(F.lit(i).cast("string"))) for i in ids] == ["260711", "000711", "other", "other", "other"]
