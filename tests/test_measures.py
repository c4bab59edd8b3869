from __future__ import annotations

from datetime import date, datetime, timedelta
from random import Random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from haltwerk import schemas as S
from haltwerk.harness import bindings as B
from haltwerk.operators import join_asof, stop_messages
from haltwerk.plans import collected_at, delay_fact, kpi_ontime_by_station_asof, planned_rows, recent_change_rows
from haltwerk.sinks import read_history, store_bucketed, upsert_history
from haltwerk.sources import shred_payloads
from haltwerk.streaming import ingest_state, mark_late

SF = "/root/testdata/sf0.001"
START = date(2024, 1, 1)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def fact(spark):
    ev = B.events(spark, SF)
    return delay_fact(planned_rows(B.planned_stops(ev)), recent_change_rows(B.changed_stops_json(ev)))


@pytest.mark.parametrize("salts", [1, 3])
def test_asof_equals_a_loop(spark, rows, salts):
    rng = Random(salts)
    versions = []
    for key in ["hot", "b", "c", None]:
        at = 0
        for n in range(6):
            a, b = at + rng.randint(0, 3), 0
            b = a + rng.randint(0, 5)
            versions.append((key, f"{key}{n}", START + timedelta(a), START + timedelta(b)))
            at = b
    events = [(rng.choice(["hot"] * 8 + ["b", "c", "d", None]), START + timedelta(rng.randint(-2, 40)), n) for n in range(300)]
    events += [("hot", None, 1000), events[0], events[0]]
    left = spark.createDataFrame(events, "k string, day date, until int")
    right = spark.createDataFrame(versions, "k string, name string, ValidFrom date, ValidTo date")
    want = []
    for k, day, n in events:
        names = [v[1] for v in versions if day and k and v[0] == k and v[2] <= day < v[3]]
        assert len(names) <= 1
        want.append((k, day, n, names[0] if names else None))
    got = join_asof(left, right, "k", "day", ["name"], salts=salts)
    assert sorted(map(str, rows(got))) == sorted(str(w) for w in want)


def test_asof_join_is_sorted_and_summed_first(spark, fact):
    text = plan(kpi_ontime_by_station_asof(fact, B.station_versions(B.table(spark, SF, "customer"))))
    assert "NestedLoop" not in text and "Cartesian" not in text
    # Partial sums by station and day lie below the window that carries the versions on.
    assert text.index("Window [last(") < text.index("partial_count(1)")


def test_asof_of_nothing(spark):
    none = spark.createDataFrame([], "k string, day date")
    versions = spark.createDataFrame([("a", "n", START, START + timedelta(1))], "k string, name string, ValidFrom date, ValidTo date")
    assert join_asof(none, versions, "k", "day", ["name"]).isEmpty()
    some = spark.createDataFrame([("a", START)], none.schema)
    assert join_asof(some, versions.limit(0), "k", "day", ["name"]).first()["name"] is None


def test_counts_come_from_the_pass_that_writes(spark, tmp_path):
    seen = Observation()
    records, _ = shred_payloads(B.payloads(B.events(spark, SF)), "s", S.PLANNED_XML, seen=seen)
    text = plan(records)
    assert text.count("FileScan") == 1 and "CollectMetrics" in text
    records.select("request_key").write.parquet(str(tmp_path / "r"))
    assert seen.get["records"] == spark.read.parquet(str(tmp_path / "r")).count()
    messages = stop_messages(B.changed_stops_json(B.events(spark, SF)), collected_at(), "", json_text=True, seen=Observation())
    assert plan(messages).count("FileScan") == 1


def test_a_body_is_built_and_parsed_once(spark):
    for df in shred_payloads(B.payloads(B.events(spark, SF)), "s", S.PLANNED_XML):
        assert plan(df).count("from_xml(") == plan(df).count("to_xml(") == 1


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path, rows, fact):
    ev = B.events(spark, SF)
    planned, changed = planned_rows(B.planned_stops(ev)), recent_change_rows(B.changed_stops_json(ev))
    tables = [store_bucketed(df, f"test_bucketed_{n}", f"{tmp_path}/{n}", 4) for n, df in (("p", planned), ("c", changed))]
    conf = {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        joined = delay_fact(*tables, apart=True)
        assert "Exchange" not in plan(joined) and plan(joined).count("SortMergeJoin") == 2
        assert sorted(map(str, rows(joined))) == sorted(map(str, rows(fact)))
    finally:
        for k in conf:
            spark.conf.unset(k)
        for n in "pc":
            spark.sql(f"DROP TABLE test_bucketed_{n}")


CHANGE = "EventId string, EventType string, IsUnplannedEvent boolean, SnapshotTimestamp timestamp, v long, IsActive boolean"


def test_late_rows_are_never_active(spark, tmp_path, rows):
    """Batches in any order, with rows of one time and rows without time; no reader guards."""
    folder, checkpoint, path = (str(tmp_path / n) for n in ("in", "cp", "history"))
    key = "1-2407110541-1"
    at = lambda h: datetime(2024, 7, 11, h) if h is not None else None
    batches = [
        [(key, at(5), 1), ("b", at(3), 2), (key, at(4), 3)],
        [(key, at(4), 4), ("c", None, 5), (None, at(9), 6)],
        [(key, at(6), 7), ("c", at(1), 8), ("b", None, 9), ("b", at(3), 10)],
    ]
    for n, batch in enumerate(batches):
        data = [(k, "Arrival", False, t, v, True) for k, t, v in batch]
        spark.createDataFrame(data, CHANGE).coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(spark.createDataFrame([], CHANGE).schema).parquet(folder)

        def append(df, number):
            upsert_history(df, path, batch=f"b{number}", late="IsLate")

        marked = mark_late(stream, S.CHANGED_KEY).writeStream.foreachBatch(append)
        marked.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    history = read_history(spark, path, spark.createDataFrame([], CHANGE).schema, S.CHANGED_KEY)
    got = rows(history, "EventId", "v", "IsActive")
    want = [(None, 6, True), (key, 1, False), (key, 4, False), (key, 7, True), ("b", 2, False), ("b", 10, True), ("c", 5, False), ("c", 8, True)]
    assert got == sorted(want, key=lambda r: [(v is not None, str(v)) for v in r])


def _marked(spark, folder, checkpoint, batch, schema, **more):
    """What a run of the stream over one more file marks."""
    found = []
    spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(schema).parquet(folder)
    marked = mark_late(stream, ["k", "l"], "at", **more).writeStream.foreachBatch(lambda df, _: found.extend(df.collect()))
    marked.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return found


def test_late_marks_equal_a_loop(spark, tmp_path):
    """Keys of two columns with NULLs and marks of JSON, rows of one time, rows without time, times that a double cannot hold."""
    rng, schema = Random(5), spark.createDataFrame([], "k string, l int, at timestamp, v string").schema
    base, seen = datetime(9000, 1, 1), {}
    for _ in range(3):
        batch = [
            (rng.choice(["a", 'a","b', "null", "", None]), rng.choice([1, 2, None]), rng.choice([None, *(base + timedelta(microseconds=n) for n in range(6))]), rng.choice([None, "x", "y"]))
            for _ in range(40)
        ]
        want = []
        for key in {r[:2] for r in batch}:
            own = [r for r in batch if r[:2] == key]
            timed = [r for r in own if r[2]]
            newest = max((r[2] for r in timed), default=None)
            first = min((r for r in own if r[2] == newest), key=lambda r: (r[3] is not None, r[3] or ""))
            want.append((*first, key in seen and (newest is None or (seen[key] is not None and newest < seen[key]))))
            seen[key] = max((x for x in (newest, seen.get(key)) if x), default=None)
        got = [tuple(r) for r in _marked(spark, f"{tmp_path}/in", f"{tmp_path}/cp", batch, schema, buckets=4)]
        assert sorted(map(str, got)) == sorted(map(str, want))


def test_late_keys_share_their_state(spark, tmp_path):
    schema = spark.createDataFrame([], "k string, l int, at timestamp, v string").schema
    batch = [(str(n), 1, datetime(2024, 1, 1), "v") for n in range(3000)]
    assert len(_marked(spark, f"{tmp_path}/in", f"{tmp_path}/cp", batch, schema)) == 3000
    assert spark.read.format("statestore").load(f"{tmp_path}/cp").count() <= 1024


def test_late_keys_go_when_their_time_is_over(spark, tmp_path):
    """Kept for less than the watermark is behind, a key goes with the batch after its own; it then counts as new."""
    schema = spark.createDataFrame([], "k string, l int, at timestamp, v string").schema
    new, old = [("a", 1, datetime(2024, 1, 2), "v")], [("a", 1, datetime(2024, 1, 1), "v")]
    run = lambda batch, cp, days: [r["IsLate"] for r in _marked(spark, f"{tmp_path}/{cp}-in", f"{tmp_path}/{cp}", batch, schema, buckets=1, keep_days=days)]
    assert run(new, "kept", 7) + run(old, "kept", 7) == [False, True]
    assert run(new, "gone", -2) + run(old, "gone", 7) == [False, False]


def test_state_of_an_ingest(spark, tmp_path, rows):
    (tmp_path / "landing").mkdir()
    (tmp_path / "archive" / "deep" / "er").mkdir(parents=True)
    (tmp_path / "landing" / "a.jsonl").write_text('{"id": "1"}\n{"id": "2"}\n')
    (tmp_path / "archive" / "deep" / "er" / "b.jsonl").write_text('{"id": "3"}\n')
    got = rows(ingest_state(spark, f"{tmp_path}/landing", f"{tmp_path}/archive"))
    assert got == [("archive", 1, 12, 1), ("landing", 1, 24, 2)]
