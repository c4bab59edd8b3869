from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from haltwerk import schemas as S
from haltwerk.operators import (
    deactivate,
    dedup_first,
    first_planned,
    latest_snapshot,
    merge_insert_only,
    scd2_flag_upsert,
    scd2_interval,
    valid_asof,
)

OPEN, RUN, OLD = date(9999, 12, 31), date(2024, 9, 1), date(2024, 1, 1)


def dim(spark, *data):
    return spark.createDataFrame(list(data), "eva_number long, creation_timestamp string, station_name string, ValidFrom date, ValidTo date")


def old(k, created="c", end=OPEN):
    return (k, created, f"old{k}", OLD, end)


def new(k, created="c"):
    return (k, created, f"new{k}", RUN, OPEN)


def interval(spark, rows, target, source, **options):
    out = scd2_interval(dim(spark, *target), dim(spark, *source), S.STATION_KEY, RUN, OPEN, **options)
    return rows(out, "station_name", "ValidTo")


def test_interval_closes_missing_and_adds_unknown(spark, rows):
    assert interval(spark, rows, [old(1), old(2)], [new(2), new(3)]) == [("new3", OPEN), ("old1", RUN), ("old2", OPEN)]


def test_closed_key_that_returns(spark, rows):
    closed = old(1, end=date(2024, 6, 1))
    assert interval(spark, rows, [closed], [new(1)]) == [("old1", date(2024, 6, 1))]
    assert interval(spark, rows, [closed], [new(1)], reopen=True) == [("new1", OPEN), ("old1", date(2024, 6, 1))]


def test_null_key_never_matches_unless_asked(spark, rows):
    assert interval(spark, rows, [old(1, None)], [new(1, None)]) == [("new1", OPEN), ("old1", RUN)]
    assert interval(spark, rows, [old(1, None)], [new(1, None)], null_safe=True) == [("old1", OPEN)]


def test_duplicate_source_rows_do_not_multiply_the_target(spark, rows):
    assert interval(spark, rows, [old(1)], [new(1), new(1), new(2), new(2)]) == [("new2", OPEN), ("new2", OPEN), ("old1", OPEN)]


def test_insert_only_keeps_the_first_version(spark, rows):
    def plan(*data):
        return spark.createDataFrame(list(data), "EventId string, v int")

    out = merge_insert_only(plan(("a", 1)), plan(("a", 2), ("b", 2), (None, 2)), ["EventId"])
    assert rows(out) == [(None, 2), ("a", 1), ("b", 2)]
    again = merge_insert_only(out, plan((None, 3)), ["EventId"])
    assert rows(again) == [(None, 2), (None, 3), ("a", 1), ("b", 2)]


FACT = "EventId string, EventType string, IsUnplannedEvent boolean, SnapshotTimestamp timestamp, v int, IsActive boolean"


def t(hour):
    return datetime(2024, 7, 11, hour)


def facts(spark, *data):
    return spark.createDataFrame(list(data), FACT)


def row(key, hour, v, active=True, unplanned=False):
    return (key, "Arrival", unplanned, None if hour is None else t(hour), v, active)


def upsert(spark, target, source, **options):
    return scd2_flag_upsert(facts(spark, *target), facts(spark, *source), S.CHANGED_KEY, **options)


def test_upsert_switches_versions(spark, rows):
    out = upsert(spark, [row("a", 1, 1), row("a", 0, 0, False), row("b", 1, 1)], [row("a", 2, 2), row("c", 2, 2)])
    assert rows(out, "EventId", "v", "IsActive") == [
        ("a", 0, False), ("a", 1, False), ("a", 2, True), ("b", 1, True), ("c", 2, True),
    ]


def test_added_then_changed_is_active_in_both_categories(spark, rows):
    out = upsert(spark, [row("a", 1, 1, unplanned=True)], [row("a", 2, 2)])
    assert rows(out, "v", "IsActive") == [(1, True), (2, True)]


def test_replays(spark, rows):
    target, late = [row("a", 3, 3)], [row("a", 1, 1)]
    assert rows(upsert(spark, target, late), "v", "IsActive") == [(1, True), (3, False)]
    assert rows(upsert(spark, target, late, guard_late=True), "v", "IsActive") == [(1, False), (3, True)]
    same = upsert(spark, target, target)
    assert rows(same, "v", "IsActive") == [(3, False), (3, True)]


@pytest.mark.parametrize(
    "target, source, want",
    [
        (None, 1, [(1, False), (2, True)]),
        (1, None, [(1, True), (2, False)]),
        (None, None, [(1, False), (2, True)]),
    ],
)
def test_undated_rows_with_late_guard(spark, rows, target, source, want):
    out = upsert(spark, [row("a", target, 1)], [row("a", source, 2)], guard_late=True)
    assert rows(out, "v", "IsActive") == want


def test_null_message_id_stays_active(spark, rows):
    def msgs(v):
        return spark.createDataFrame([("a", "Stop", None, v, True)], "EventId string, EventType string, MessageId string, v int, IsActive boolean")

    assert rows(scd2_flag_upsert(msgs(1), msgs(2), S.MESSAGE_KEY), "v", "IsActive") == [(1, True), (2, True)]
    assert rows(scd2_flag_upsert(msgs(1), msgs(2), S.MESSAGE_KEY, null_safe=True), "v", "IsActive") == [(1, False), (2, True)]


def test_deactivate_leaves_other_rows(spark, rows):
    target = facts(spark, row("a", 1, 1), row("b", 1, 2), row("a", 1, 3, None))
    out = deactivate(target, facts(spark, row("a", 2, 9), row("a", 2, 9)), S.CHANGED_KEY)
    assert rows(out, "v", "IsActive") == [(1, False), (2, True), (3, None)]


def test_at_most_one_active_row_after_any_sequence(spark):
    state = facts(spark, row("a", 0, 0))
    for n in range(1, 5):
        batch = facts(spark, *(row(k, h, 10 * n + h) for k in "abc"[: n % 3 + 1] for h in (n, 5 - n)))
        state = scd2_flag_upsert(state, latest_snapshot(batch, S.CHANGED_KEY), S.CHANGED_KEY, guard_late=n % 2 == 0)
    active = state.where("IsActive").groupBy(*S.CHANGED_KEY).count()
    assert active.where("count > 1").isEmpty() and active.count() == 3


def test_ties_are_settled_whatever_the_input_order(spark, rows):
    tied = [row("a", 1, v) for v in range(40)]
    for data, parts in ((tied, 1), (tied[::-1], 7)):
        df = facts(spark, *data).repartition(parts)
        assert rows(latest_snapshot(df, S.CHANGED_KEY), "v") == [(0,)]
    assert rows(dedup_first(facts(spark, *tied), ["EventId"], [F.col("v").desc()], []), "v") == [(39,)]


def test_timeless_plan_row_comes_first(spark, rows):
    plans = spark.createDataFrame(
        [("a", 5, 6), ("a", None, None), ("b", None, 4), ("b", 3, None)],
        "EventId string, Arrival_PlannedTime long, Departure_PlannedTime long",
    )
    assert rows(first_planned(plans)) == [("a", None, None), ("b", 3, None)]


def test_asof_interval_is_half_open_and_suffix_is_exact(spark, rows):
    data = [(n, "c", name, OLD, end) for n, (name, end) in enumerate(
        [("X Hbf", OPEN), ("X Hbf (tief)", OPEN), ("x hbf", OPEN), ("Y Hbf", RUN)])]
    assert rows(valid_asof(dim(spark, *data), RUN, "Hbf"), "station_name") == [("X Hbf",)]
    assert rows(valid_asof(dim(spark, *data), OLD, "Hbf"), "station_name") == [("X Hbf",), ("Y Hbf",)]
