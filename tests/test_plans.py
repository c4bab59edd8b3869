"""What the physical plans must look like, and a brute-force check of the stored history."""

from __future__ import annotations

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from haltwerk import schemas as S
from haltwerk.harness import bindings as B
from haltwerk.operators import latest_snapshot, merge_insert_only, stop_events, stop_messages, worklist
from haltwerk.plans import SERVICE_DAY, collected_at, delay_fact, planned_rows, recent_change_rows
from haltwerk.sinks import append_new, read_active, read_appended, read_history, upsert_history

SF = "/root/testdata/sf0.001"
PURE = (  # queries whose plan is not preceded by writes
    "payload_yield request_worklist station_asof planned_first change_events latest_change messages_json latest_message "
    "merge_insert_only scd2_interval scd2_deactivate_events scd2_upsert_messages delay_fact kpi_ontime_station"
).split()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def stops(spark, tmp_path):
    path = str(tmp_path / "stops")
    B.changed_stops_json(B.events(spark, SF)).write.parquet(path)
    return spark.read.schema(S.CHANGED_JSON).parquet(path)


@pytest.mark.parametrize("name", PURE)
def test_no_pairwise_join_and_no_python(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert bad not in text


def test_one_row_per_key_leaves_each_task(spark, stops):
    before_shuffle = plan(recent_change_rows(stops)).split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in before_shuffle


def test_shredding_scans_once_and_reads_narrow(spark, stops):
    events = plan(stop_events(stops, collected_at(), "", distinct_stops=False))
    assert events.count("FileScan") == 1 and "Exchange" not in events
    schema = events.split("ReadSchema:")[1]
    assert "clt:string" in schema and "m:string" not in schema  # message texts are not read
    messages = plan(stop_messages(stops, collected_at(), "", json_text=True))
    assert messages.count("FileScan") == 1
    assert "clt:string" not in messages.split("ReadSchema:")[1]


def test_small_batch_does_not_shuffle_the_target(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).select(F.col("id").cast("string").alias("EventId"), F.lit(1).alias("v")).write.parquet(path)
    target = spark.read.parquet(path)
    batch = spark.range(5).select(F.col("id").cast("string").alias("EventId"), F.lit(2).alias("v"))
    text = plan(merge_insert_only(target, batch, ["EventId"]))
    assert "SortMergeJoin" not in text and "LeftSemi, BuildRight" in text


def test_messages_are_filtered_by_the_scan(spark, stops):
    text = plan(stop_messages(stops, collected_at(), "", json_text=True))
    pushed = text.split("PushedFilters:")[1].split("]")[0]
    assert "IsNotNull(ar.m)" in pushed and "IsNotNull(dp.m)" in pushed and "IsNotNull(m)" in pushed


def test_a_filter_on_the_day_reaches_both_tables(spark, tmp_path, stops):
    for n in range(2):
        upsert_history(recent_change_rows(stops), str(tmp_path / "c"), batch=f"b{n}")
    plans = planned_rows(B.planned_stops(B.events(spark, SF)))
    append_new(plans, str(tmp_path / "p"), S.PLANNED_KEY)
    planned = read_appended(spark, str(tmp_path / "p"), S.FACT_PLANNED, day=SERVICE_DAY)
    changed = read_active(spark, str(tmp_path / "c"), S.FACT_CHANGED, S.CHANGED_KEY, day=SERVICE_DAY)
    for fact in (delay_fact(planned, changed, days=["240102"]), delay_fact(planned, changed).where("ServiceDay = '240102'")):
        scans = plan(fact).split("FileScan")[1:]
        assert len(scans) >= 3 and all("240102" in x.split("PartitionFilters:")[1].split("PushedFilters")[0] for x in scans)
    assert "WindowGroupLimit" in plan(changed)


def test_worklist_is_no_cross_join(spark):
    stations = spark.range(3).select(F.col("id").alias("eva_number"))
    rows = worklist(stations, datetime(2024, 7, 1).date()).collect()
    assert len(rows) == 72 and {r["hour"] for r in rows} == {f"{h:02d}" for h in range(24)}
    assert {r["day_key"] for r in rows} == {"240701"}


@pytest.mark.parametrize("seed, guard_late", [(1, False), (2, True)])
def test_random_batches_match_a_model(spark, tmp_path, seed, guard_late):
    """Stored history against a plain loop over dictionaries."""
    rnd = random.Random(seed)
    schema = "EventId string, EventType string, IsUnplannedEvent boolean, SnapshotTimestamp timestamp, v int, IsActive boolean"
    history, path, v = [], str(tmp_path), 0
    for n in range(4):
        data = []
        for _ in range(30):
            v += 1
            key = (f"{rnd.randrange(6)}-24071{rnd.randrange(3)}0541-1", rnd.choice(["Arrival", "Stop"]), rnd.random() < 0.3)
            data.append((*key, datetime(2024, 7, 11, rnd.randrange(24)), v, True))
        upsert_history(
            latest_snapshot(spark.createDataFrame(data, schema), S.CHANGED_KEY), path, batch=f"b{n}"
        )
        newest = {}
        for row in data:
            best = newest.get(row[:3])
            if best is None or (row[3], -row[4]) > (best[3], -best[4]):
                newest[row[:3]] = row
        for key, row in newest.items():
            active = [i for i, h in enumerate(history) if h[:3] == key and h[5]]
            late = guard_late and any(history[i][3] > row[3] for i in active)
            if not late:
                for i in active:
                    history[i] = (*history[i][:5], False)
            history.append((*row[:5], not late))
    stored = read_history(spark, path, spark.createDataFrame([], schema).schema, S.CHANGED_KEY, guard_late=guard_late)
    assert sorted(tuple(r) for r in stored.collect()) == sorted(history)
