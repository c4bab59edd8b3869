from __future__ import annotations

from datetime import date, datetime
from json import dumps
from random import Random
from threading import Barrier, Event

import pytest
from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import functions as F

from haltwerk import schemas as S
from haltwerk.harness import queries
from haltwerk.operators import batch_profile, find_event, open_main_stations, require_nonempty
from haltwerk.plans import delay_fact, kpi_ontime, load_full, load_recent_changes, load_stations, recent_change_rows, register_views
from haltwerk.sinks import (
    append_new,
    create_if_absent,
    publish,
    read_active,
    read_appended,
    read_history,
    read_whole,
    upsert_history,
)
from haltwerk.session import together
from haltwerk.sources import archive_raw, read_records_json, read_records_xml, split_rejects, write_records_json
from haltwerk.streaming import ingest_stream, scd2_stream, stream

FACT = "EventId string, EventType string, IsUnplannedEvent boolean, SnapshotTimestamp timestamp, v int, IsActive boolean"


def batch(spark, hour, *keys):
    data = [(k, "Arrival", False, datetime(2024, 7, 11, hour), hour, True) for k in keys]
    return spark.createDataFrame(data, FACT)


A, B, C = "1-2407110541-1", "2-2407120541-1", "plain"


def upsert(df, path, **options):
    return upsert_history(df, str(path), **options)


def history(spark, path, schema, **options):
    return read_history(spark, str(path), schema, S.CHANGED_KEY, **options)


def test_history_keeps_every_version(spark, tmp_path, rows):
    for hour, keys in ((1, (A, B, C)), (2, (A,)), (3, (A, C))):
        upsert(batch(spark, hour, *keys), tmp_path)
    schema = batch(spark, 1, A).schema
    got = rows(history(spark, tmp_path, schema), "EventId", "v", "IsActive")
    assert got == [(A, 1, False), (A, 2, False), (A, 3, True), (B, 1, True), (C, 1, False), (C, 3, True)]
    active = read_active(spark, str(tmp_path), schema, S.CHANGED_KEY)
    assert rows(active, "EventId", "v", "IsActive") == [(A, 3, True), (B, 1, True), (C, 3, True)]
    assert active.schema.names == schema.names


def test_a_batch_writes_its_own_rows_only(spark, tmp_path):
    upsert(batch(spark, 1, A, B, C), tmp_path, batch="large")
    upsert(batch(spark, 2, A), tmp_path, batch="small")
    written = spark.read.parquet(str(tmp_path / "data")).groupBy("batch", "part").count().collect()
    assert {tuple(r) for r in written if r["batch"] == "small"} == {("small", "240711", 1)}
    assert sum(r["count"] for r in written) == 4


def test_batch_is_committed_once(spark, tmp_path):
    assert upsert(batch(spark, 1, A), tmp_path, batch="b1#/ä")
    assert not upsert(batch(spark, 1, A), tmp_path, batch="b1#/ä")
    assert spark.read.parquet(str(tmp_path / "data")).count() == 1


def test_two_writers_lose_nothing(spark, tmp_path, rows, monkeypatch):
    """A second batch that begins and ends while the first one is being written."""
    import haltwerk.sinks.snapshots as snapshots

    write, schema = snapshots._write_batch, batch(spark, 1, A).schema

    def interleaved(df, path, name, began):
        monkeypatch.setattr(snapshots, "_write_batch", write)
        upsert(batch(spark, 2, A, B), tmp_path, batch="inner")
        write(df, path, name, began)

    monkeypatch.setattr(snapshots, "_write_batch", interleaved)
    upsert(batch(spark, 1, A), tmp_path, batch="outer")
    got = rows(history(spark, tmp_path, schema), "EventId", "v", "IsActive")
    assert got == [(A, 1, False), (A, 2, True), (B, 2, True)]  # the inner one began later


def test_a_lost_attempt_is_not_seen(spark, tmp_path, rows):
    """Rows are visible once the job has committed; a job that dies leaves a staging folder at most."""
    schema = batch(spark, 1, A).schema
    upsert(batch(spark, 1, A), tmp_path, batch="b1")
    lost = batch(spark, 2, A).withColumn("v", F.when(F.col("v") == 2, F.raise_error("lost").cast("int")))
    with pytest.raises(Exception, match="lost"):
        upsert(lost, tmp_path, batch="b2")
    assert rows(history(spark, tmp_path, schema), "v", "IsActive") == [(1, True)]
    assert upsert(batch(spark, 2, A), tmp_path, batch="b2")
    assert rows(history(spark, tmp_path, schema), "v", "IsActive") == [(1, False), (2, True)]


def test_null_keys_are_all_active(spark, tmp_path, rows):
    for hour in (1, 2):
        upsert(batch(spark, hour, None, None, A), tmp_path)
    schema = batch(spark, 1, A).schema
    want = [(None, 1, True), (None, 1, True), (None, 2, True), (None, 2, True), (A, 1, False), (A, 2, True)]
    assert rows(history(spark, tmp_path, schema), "EventId", "v", "IsActive") == want
    active = read_active(spark, str(tmp_path), schema, S.CHANGED_KEY)
    assert rows(active, "EventId", "v") == [w[:2] for w in want if w[2]]


def test_one_day_lists_one_day(spark, tmp_path):
    upsert(batch(spark, 1, A, B, C), tmp_path)
    schema = batch(spark, 1, A).schema
    files = history(spark, tmp_path, schema, days=["240711"]).inputFiles()
    assert files and all("part=240711" in f for f in files)
    assert history(spark, tmp_path, schema, days=["240101"]).isEmpty()
    assert history(spark, tmp_path, schema, days=[]).isEmpty()


def test_append_new(spark, tmp_path, rows):
    def plan(v, *keys):
        return spark.createDataFrame([(k, v) for k in keys], "EventId string, v int")

    for v, keys in ((1, "ab"), (2, "bc"), (3, "c")):
        append_new(plan(v, *keys), str(tmp_path), ["EventId"], f"b{v}")
    assert not append_new(plan(9, "z"), str(tmp_path), ["EventId"], "b1")
    assert rows(read_appended(spark, str(tmp_path), plan(0, "a").schema)) == [("a", 1), ("b", 1), ("c", 2)]


def test_create_if_absent(spark, tmp_path):
    readers = {
        "whole": read_whole,
        "appended": read_appended,
        "history": lambda *a: read_history(*a, S.CHANGED_KEY),
        "active": lambda *a: read_active(*a, S.CHANGED_KEY),
    }
    for name, read in readers.items():
        path = f"{tmp_path}/{name}"
        assert create_if_absent(spark, path, S.FACT_CHANGED)
        assert not create_if_absent(spark, path, S.FACT_CHANGED)
        empty = read(spark, path, S.FACT_CHANGED)
        assert empty.isEmpty() and empty.schema.names == S.FACT_CHANGED.names
    path = f"{tmp_path}/history"
    load_recent_changes(spark.read.schema(S.CHANGED_JSON).json(spark.sparkContext.parallelize([dumps(json_stop(A, 6))])), path)
    assert not create_if_absent(spark, path, S.FACT_CHANGED)
    assert read_history(spark, path, S.FACT_CHANGED, S.CHANGED_KEY).count() == 1


def raw_stations(spark, n):
    data = [(str(k), "D", f"S{k} Hbf", "m", "true", "c", "u") for k in range(n)]
    return spark.createDataFrame(data, S.STATION_XML)


@pytest.mark.parametrize("n, committed", [(129, False), (130, True)])
def test_guard_on_main_stations(spark, tmp_path, n, committed):
    path = str(tmp_path)
    assert load_stations(raw_stations(spark, 200), path, date(2024, 1, 1))
    assert load_stations(raw_stations(spark, n), path, date(2024, 2, 1)) is committed
    open_now = read_whole(spark, path, S.DIM_STATIONS).agg(open_main_stations().alias("n")).first()["n"]
    assert open_now == (n if committed else 200)
    assert load_stations(raw_stations(spark, 201), path, date(2024, 3, 1))  # goes on from the last good one


def test_a_station_list_is_loaded_once(spark, tmp_path, rows):
    path = str(tmp_path)
    assert load_stations(raw_stations(spark, 3), path, date(2024, 1, 1), 1, batch="a")
    assert load_stations(raw_stations(spark, 4), path, date(2024, 2, 1), 1, batch="b")
    assert not load_stations(raw_stations(spark, 3), path, date(2024, 3, 1), 1, batch="a")
    assert read_whole(spark, path, S.DIM_STATIONS).where("ValidTo = DATE '9999-12-31'").count() == 4


def test_publish_does_not_overwrite_what_is_read(spark, tmp_path, rows):
    path = str(tmp_path)
    publish(spark.range(3), path)
    publish(read_whole(spark, path, spark.range(1).schema).where("id > 0"), path)
    assert rows(read_whole(spark, path, spark.range(1).schema)) == [(1,), (2,)]


def test_sources(spark, tmp_path, rows):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_records_json(spark, f"{tmp_path}/none_*.jsonl", S.CHANGED_JSON)
    (tmp_path / "empty_1.jsonl").write_text("")
    with pytest.raises(ValueError, match="no records"):
        require_nonempty(read_records_json(spark, f"{tmp_path}/empty_*", S.CHANGED_JSON))
    write_records_json(spark.range(10).repartition(3), f"{tmp_path}/j")
    (tmp_path / "j" / "part-empty.json").write_text("")
    df = read_records_json(spark, f"{tmp_path}/j/part-*", spark.range(1).schema)
    got = batch_profile(df, f"{tmp_path}/j/part-*").first()
    assert (got["n_files"], got["n_records"]) == (4, 10) and got["n_bytes"] == 10 * len('{"id":0}\n')
    for name in ("a", "b", "a"):
        archive_raw(df, f"{tmp_path}/archive", name, datetime(2024, 7, 11, 6, 5, 4))
    kept = spark.read.parquet(f"{tmp_path}/archive")
    assert rows(kept.groupBy("batch_id").count()) == [("a", 10), ("b", 10)]
    (tmp_path / "r.jsonl").write_text('{"id": "x"}\n{"id": \n{"eva": "1"}\n')
    records, rejects = split_rejects(read_records_json(spark, f"{tmp_path}/r.jsonl", S.CHANGED_JSON))
    assert rows(records, "id") == [("x",)] and rows(rejects) == [(2,)]


def json_stop(key, hour, minute=0, ct="2407110541", status=None, message="m1"):
    side = {"ct": ct, "cs": status, "m": f'[{{"id":"{message}","t":"h","ts":"2407110500"}}]'}
    return {"id": key, "eva": "1", "_collected_at": f"2024-07-11T{hour:02d}:{minute:02d}:00+00:00", "ar": side}


def land(folder, name, *stops):
    import json

    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(s) for s in stops) + "\n")


def run_stream(spark, base, **options):
    stream = ingest_stream(spark, str(base / "landing"), archive=str(base / "archive"), files_per_batch=1)
    scd2_stream(stream, str(base / "changes"), str(base / "messages"), str(base / "cp"), **options).awaitTermination()


def test_stream_equals_batch_and_replays_nothing(spark, tmp_path, rows):
    landing = tmp_path / "landing"
    land(landing, "r_1.jsonl", json_stop(A, 6), json_stop(B, 6))
    run_stream(spark, tmp_path)
    land(landing, "r_2.jsonl", json_stop(A, 7, ct="2407110600"))
    run_stream(spark, tmp_path)
    run_stream(spark, tmp_path)  # nothing new
    columns = ("EventId", "ChangedTime", "IsActive")
    got = rows(read_history(spark, str(tmp_path / "changes"), S.FACT_CHANGED, S.CHANGED_KEY, guard_late=True), *columns)
    assert got == [(A, 2407110541, False), (A, 2407110600, True), (B, 2407110541, True)]
    messages = rows(read_history(spark, str(tmp_path / "messages"), S.FACT_MESSAGES, S.MESSAGE_KEY), "EventId", "IsActive")
    assert messages == [(A, False), (A, True), (B, True)]

    for n, name in enumerate(("r_1.jsonl", "r_2.jsonl")):
        found = [p for p in tmp_path.rglob(name) if p.is_file()]
        load_recent_changes(spark.read.schema(S.CHANGED_JSON).json(str(found[0])), str(tmp_path / "again"), f"b{n}")
    assert rows(read_history(spark, str(tmp_path / "again"), S.FACT_CHANGED, S.CHANGED_KEY), *columns) == got


def test_stream_survives_a_lost_checkpoint(spark, tmp_path, rows):
    """A replay of batches that both tables already have changes neither."""
    landing = tmp_path / "landing"
    land(landing, "r_1.jsonl", json_stop(A, 6))
    stream = lambda cp: scd2_stream(
        ingest_stream(spark, str(landing)), str(tmp_path / "c"), str(tmp_path / "m"), str(tmp_path / cp), name="feed"
    ).awaitTermination()
    stream("cp1")
    stream("cp2")
    assert rows(read_history(spark, str(tmp_path / "c"), S.FACT_CHANGED, S.CHANGED_KEY), "EventId", "IsActive") == [(A, True)]


def test_stream_late_file_does_not_win(spark, tmp_path, rows):
    landing = tmp_path / "landing"
    land(landing, "r_1.jsonl", json_stop(A, 7, ct="2407110600"))
    run_stream(spark, tmp_path)
    land(landing, "r_2.jsonl", json_stop(A, 6))
    run_stream(spark, tmp_path)
    got = rows(read_history(spark, str(tmp_path / "changes"), S.FACT_CHANGED, S.CHANGED_KEY, guard_late=True), "ChangedTime", "IsActive")
    assert got == [(2407110541, False), (2407110600, True)]


def test_a_batch_loads_both_facts_side_by_side(spark, tmp_path, monkeypatch):
    both = Barrier(2)
    for load in ("load_recent_changes", "load_recent_messages"):
        monkeypatch.setattr(stream, load, lambda *args, f=getattr(stream, load): (both.wait(60), f(*args)))
    (tmp_path / "landing").mkdir()
    (tmp_path / "landing" / "a.jsonl").write_text(dumps(json_stop(A, 6)))
    run_stream(spark, tmp_path)
    assert read_history(spark, str(tmp_path / "changes"), S.FACT_CHANGED, S.CHANGED_KEY).count() == 1


def test_a_fact_that_fails_leaves_the_other_whole(spark, tmp_path, rows, monkeypatch):
    (tmp_path / "landing").mkdir()
    (tmp_path / "landing" / "a.jsonl").write_text(dumps(json_stop(A, 6)))

    def fails(*_):
        raise ValueError("no changes today")

    with monkeypatch.context() as m:
        m.setattr(stream, "load_recent_changes", fails)
        with pytest.raises(StreamingQueryException):
            run_stream(spark, tmp_path)
    tables = (("changes", S.FACT_CHANGED, S.CHANGED_KEY), ("messages", S.FACT_MESSAGES, S.MESSAGE_KEY))
    count = lambda: [read_history(spark, str(tmp_path / t), schema, key).count() for t, schema, key in tables]
    assert count() == [0, 1]
    run_stream(spark, tmp_path)  # the batch again: messages are there already
    assert count() == [1, 1]


def test_together_ends_all_steps_before_it_raises(spark):
    seen, failed = [], Event()

    def fails():
        failed.set()
        raise ValueError("first")

    with pytest.raises(ValueError, match="first"):
        together(spark, fails, lambda: seen.append((failed.wait(60), spark.range(5).count())))
    assert seen == [(True, 5)]
    assert together(spark, lambda: 1, lambda: 2) == [1, 2]


def test_batches_in_few_row_groups_are_dealt_out(spark, tmp_path):
    events = spark.range(0, 80, 1, 1).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-18 00:00:00' + make_dt_interval(0, id) AS ts", "id % 7 AS user_id", "'click' AS event_type", "1.0D AS value"
    )
    events.write.parquet(f"{tmp_path}/events.parquet")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        base = queries._streamed(spark, str(tmp_path), f"{tmp_path}/s")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = [f for place in ("landing", "archive") for f in (tmp_path / "s" / place).rglob("part-*.json")]
    assert len(files) > 8 and read_history(spark, f"{base}/changes", S.FACT_CHANGED, S.CHANGED_KEY).count() > 0


def test_views_follow_their_tables(spark, tmp_path, rows):
    paths = [f"{tmp_path}/{n}" for n in ("stations", "planned", "changes", "messages")]
    register_views(spark, *paths)
    count = lambda: spark.sql("SELECT count(*) AS n FROM fact_changedtimetable").first()["n"]
    assert count() == 0 and spark.sql("SELECT count(*) AS n FROM v_traindelayfact").first()["n"] == 0
    for n, key in enumerate((A, B), 1):
        lines = spark.sparkContext.parallelize([dumps(json_stop(key, 6))])
        load_recent_changes(spark.read.schema(S.CHANGED_JSON).json(lines), paths[2])
        assert count() == n
    upsert(read_history(spark, paths[2], S.FACT_CHANGED, S.CHANGED_KEY).limit(1), paths[2])  # not by a load
    assert count() == 3
    (tmp_path / "landing").mkdir()
    (tmp_path / "landing" / "a.jsonl").write_text(dumps(json_stop(A, 7)))
    run_stream(spark, tmp_path)  # its batches have a session of their own
    assert count() == 4
    assert spark.sql("SELECT count(*) AS n FROM fact_changedtimetable WHERE ServiceDay = '240712'").first()["n"] >= 1
    history = read_history(spark, paths[2], S.FACT_CHANGED, S.CHANGED_KEY, day="ServiceDay")
    assert rows(spark.table("fact_changedtimetable")) == rows(history)
    register_views(spark, *paths, guard_late=True)  # again, over tables with rows
    history = read_history(spark, paths[2], S.FACT_CHANGED, S.CHANGED_KEY, guard_late=True, day="ServiceDay")
    assert rows(spark.table("fact_changedtimetable")) == rows(history)
    assert load_stations(raw_stations(spark, 200), paths[0], date(2024, 1, 1))
    assert not load_stations(raw_stations(spark, 2), paths[0], date(2024, 2, 1))
    assert spark.table("dim_stations").count() == read_whole(spark, paths[0], S.DIM_STATIONS).count() == 200


def test_a_view_on_one_day_reads_one_day(spark, tmp_path):
    paths = [f"{tmp_path}/{n}" for n in ("stations", "planned", "changes", "messages")]
    register_views(spark, *paths)
    upsert(batch_of_changes(spark, A, B), paths[2])
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    plan = spark.sql("SELECT * FROM v_traindelayfact WHERE ServiceDay = '240711'")._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert scans and all("240711" in line.split("PartitionFilters")[1] for line in scans)


def batch_of_changes(spark, *keys):
    lines = spark.sparkContext.parallelize([dumps(json_stop(k, 6)) for k in keys])
    return recent_change_rows(spark.read.schema(S.CHANGED_JSON).json(lines))


def test_full_load_feeds_both_facts(spark, tmp_path, rows):
    stop = "<s id='1-2407110541-1' eva='1'><ar ct='2407110541'><m id='m1' t='h' ts='2407110500'/></ar></s>"
    (tmp_path / "f.xml").write_text(f"<timetable>{stop}</timetable>")
    stops = read_records_xml(spark, f"{tmp_path}/f.xml", S.CHANGED_XML, "s", root_tag="timetable")
    assert load_full(stops, f"{tmp_path}/c", f"{tmp_path}/m", datetime(2024, 7, 11)) == (True, True)
    assert read_history(spark, f"{tmp_path}/c", S.FACT_CHANGED, S.CHANGED_KEY).count() == 1
    assert read_history(spark, f"{tmp_path}/m", S.FACT_MESSAGES, S.MESSAGE_KEY).count() == 1


def test_delay_fact_cases(spark, rows):
    nothing = (None,) * 4
    plan = spark.createDataFrame(
        [
            ("1", "p", "RE", "RE 1", "NO", None, None, "1", 2407110500, "NO", None, None, "2", 2407110505),
            ("1", "q", "RE", None, *nothing, None, "NO", None, None, "3", 2407112355),
        ],
        S.FACT_PLANNED,
    )
    now = datetime(2024, 7, 11)

    def change(key, kind, ct=None, cp=None, status=None, unplanned=False, active=True):
        return (9, key, now, kind, None, cp, ct, "L", status, unplanned, active)

    changed = spark.createDataFrame(
        [
            change("p", "Arrival", 2407110507, "9"),
            change("p", "Departure", status="c"),
            change("p", "Departure", 2407110600, active=False),
            change("q", "Departure", 2407120003),
            change("q", "Departure", 2407120010, unplanned=True),  # added as well as planned: two rows
            change("r", "Arrival", unplanned=True, status="a"),  # added, no time
            change("r", "Arrival", 2407110700),
            change("s", "Stop", unplanned=True),
        ],
        S.FACT_CHANGED,
    )
    fact = delay_fact(plan, changed)
    got = rows(fact, "EVA_Number", "EventId", "EventType", "ActualPlatform", "DelayMinutes", "IsCancelled")
    assert got == [
        ("1", "p", "Arrival", "9", 7, False),
        ("1", "p", "Departure", "2", 0, True),
        ("1", "q", "Departure", "3", 8, False),
        ("9", "q", "Departure", None, -7, False),
        ("9", "r", "Arrival", None, None, False),
    ]
    assert rows(kpi_ontime(fact, ["EVA_Number"]), "EVA_Number", "n_events", "n_on_time") == [("1", 2, 0), ("9", 1, 1)]
    assert find_event(fact, "p").count() == 2


def test_work_dir_refuses_a_cluster_without_a_shared_folder():
    from types import SimpleNamespace as N

    from haltwerk.session import shared_dir

    def session(master, named):
        context = N(master=master, getCheckpointDir=lambda: None)
        return N(conf=N(get=lambda k, d=None: named), sparkContext=context)

    assert shared_dir(session("yarn", "hdfs://x/cp/")) == "hdfs://x/cp"
    with pytest.raises(RuntimeError):
        shared_dir(session("yarn", None))


ID = "_id string"


@pytest.mark.parametrize(
    "text, ids",
    [
        ('<s id="1"/><s id="2"/><s id="3"><ar></s><s id="4"><ar/></s>', ["1", "2", None, "4"]),
        ('<?xml version="1.0"?><!DOCTYPE timetable [<!ELEMENT s ANY>]><timetable><s id="1"><ar/></s><s id="2"/></timetable>', ["1", "2"]),
        ('<timetable><s id="1"/><s id="2"/></timetable>', ["1", "2"]),
        ('<timetable><s id="1"><ar/></s><!-- a </s> b --><s id="2"><ar/></s><!-- <s id="9"/> --></timetable>', ["1", "2"]),
        ('<timetable><s id="1"><ar/><!-- c </s> d --></s><s id="2"/></timetable>', ["1", "2"]),
        ("<timetable></timetable>", []),
        ('<timetable><s id="1" <ar/></s><s id="2"/><s id="3"><ar/></s></timetable>', [None, "2", "3"]),
    ],
)
def test_split_xml_loses_no_record(spark, tmp_path, text, ids):
    (tmp_path / "f.xml").write_text(text)
    got = read_records_xml(spark, f"{tmp_path}/f.xml", spark.createDataFrame([], ID).schema, "s", root_tag="timetable")
    assert [r["_id"] for r in got.collect()] == ids


@pytest.mark.parametrize(
    "body",
    [
        '<s id="1"/><s id="2"><ar/></s><s id="3"/>',
        '<s id="1"/><s id="2"/>',
        '<!-- x --><s id="1"><ar/><!-- y --></s>',
        '<s id="1"/><s id="2"/><s id="3"><ar></s>',
        '<s id="1"><ar/></s><!-- <s id="x"></s><s id="y"></s> --><s id="2"><ar/></s>',
        '<s id="1"><ar><![CDATA[</s><s id="9"><timetable><!-- </s> -->]]></ar></s><?go </s> ?><s id="2"><ar/></s>',
        '<s id="1"><ar/></s ><s id="2"><ar/></s>',
    ],
)
@pytest.mark.parametrize("head", ["", '<?xml version="1.0"?><!DOCTYPE timetable>'])
def test_split_xml_equals_the_reader(spark, tmp_path, head, body):
    """That reader loses what follows a broken record in its file, so such a record stands last here."""
    (tmp_path / "f.xml").write_text(f"{head}<timetable>{body}</timetable>")
    schema = spark.createDataFrame([], ID).schema
    split = read_records_xml(spark, f"{tmp_path}/f.xml", schema, "s", root_tag="timetable").collect()
    assert split == read_records_xml(spark, f"{tmp_path}/f.xml", schema, "s").collect()


def _some_xml(rng):
    """Records with comments, CDATA sections and instructions that hold tags and each other's marks."""
    inside = ["</s>", "<s id='z'>", " x ", " words" * 6]

    def held(start, end, others):
        return start + "".join(rng.choice(inside + others) for _ in range(rng.randint(0, 12))) + end

    def any_of():
        return rng.choice([held("<!--", "-->", ["<![CDATA[", "]]>", "<?", "?>"]), held("<?go ", "?>", ["<!--", "-->", "<![CDATA["]), "\n"])

    def cdata():
        return held("<![CDATA[", "]]>", ["<!--", "-->", "<?", "?>"])

    kinds = [
        lambda i: f'<s id="{i}"/>',
        lambda i: f'<s id="{i}"><t>v{i}</t></s>',
        lambda i: f'<s id="{i}">{any_of()}<t>v{i}{cdata()}</t></s>{any_of()}',
    ]
    return "<timetable>" + "".join(rng.choice(kinds)(i) for i in range(40)) + "</timetable>"


@pytest.mark.parametrize("split_bytes", [64, 300, 1 << 27])
def test_constructs_over_splits(spark, tmp_path, rows, monkeypatch, split_bytes):
    """Two files in splits that end inside constructs, also with every join dealt by a shuffle."""
    import haltwerk.sources.xml as xml

    rng = Random(split_bytes)
    for name in "ab":
        (tmp_path / f"{name}.xml").write_text(_some_xml(rng))
    (tmp_path / "c.xml").write_text('<timetable><s id="clean"><t/></s></timetable>')
    schema = spark.createDataFrame([], "_id string, t string").schema
    want = rows(read_records_xml(spark, str(tmp_path), schema, "s"))
    conf = {"spark.sql.files.maxPartitionBytes": split_bytes, "spark.sql.files.openCostInBytes": 1}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        assert rows(read_records_xml(spark, str(tmp_path), schema, "s", root_tag="timetable")) == want
        monkeypatch.setattr(xml, "_FEW", 0)
        assert rows(read_records_xml(spark, str(tmp_path), schema, "s", root_tag="timetable")) == want
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_broken_xml_files_follow_the_rows_and_not_the_ids(spark, tmp_path, rows, monkeypatch):
    """Ids far apart, one of them twice and one NULL: a file for each 5,000 rows, and all records."""
    from haltwerk.harness import queries

    ids = [*range(0, 300_000, 1000), 1000, None]
    spark.createDataFrame([(i,) for i in ids], "event_id long").write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(queries, "work_dir", lambda _, label: f"{tmp_path}/{label}")
    got = dict(rows(queries.broken_xml(spark, str(tmp_path))))
    broken = [i for i in range(0, 300_000, 1000) if i % 7 == 2]
    assert got.pop(None) == len(broken)
    assert got == {str(i): 2 if i == 1000 else 1 for i in range(0, 300_000, 1000) if i % 7 != 2}
    assert len(list((tmp_path / "broken").glob("part-*"))) == 1
    monkeypatch.setattr(queries, "_EVENTS_A_DOCUMENT", 50)
    monkeypatch.setattr(queries, "work_dir", lambda _, label: f"{tmp_path}/{label}-50")
    assert dict(rows(queries.broken_xml(spark, str(tmp_path)))) == got | {None: len(broken)}
    assert 1 < len(list((tmp_path / "broken-50").glob("part-*"))) <= 7
