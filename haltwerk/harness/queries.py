"""One query per operator on the test tables; ``oracle.py`` states each in SQL."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions import batch_name, delay_minutes, pack_time, packed_time
from ..operators import (
    MAIN_STATION_SUFFIX,
    OPEN_END,
    batch_profile,
    clean_stations,
    deactivate,
    find_event,
    first_planned,
    flatten_planned,
    merge_insert_only,
    message_rejects,
    null_audit,
    open_main_stations,
    require_nonempty,
    scd2_flag_upsert,
    scd2_interval,
    stop_events,
    stop_messages,
    valid_asof,
    worklist,
)
from ..plans import (
    SERVICE_DAY,
    added_events,
    collected_at,
    delay_fact,
    kpi_cancellation,
    kpi_ontime,
    kpi_ontime_by_station,
    kpi_ontime_by_station_asof,
    kpi_overview,
    load_full_changes,
    load_full_messages,
    load_planned,
    load_recent_changes,
    load_recent_messages,
    load_stations,
    planned_events,
    planned_rows,
    recent_change_rows,
    recent_message_rows,
    register_views,
)
from ..session import together, work_dir
from ..sinks import (
    create_if_absent,
    current_snapshot,
    guarded_publish,
    publish,
    read_active,
    read_appended,
    read_history,
    read_whole,
    store_bucketed,
)
from ..sources import (
    archive_raw,
    parse_record,
    payload_yield,
    read_records_json,
    read_records_xml,
    record_text,
    shred_payloads,
    split_rejects,
    write_records_json,
    write_records_xml,
)
from ..streaming import ingest_state, ingest_stream, late_safe_stream, scd2_stream
from . import bindings as B

Query = Callable[[SparkSession, str], DataFrame]

_PAYLOAD_STOP = S.PLANNED_XML
#: Events in a document of `xml_broken_records`, about 400 kB.
_EVENTS_A_DOCUMENT = 5_000


def _zone_free(df: DataFrame) -> DataFrame:
    """Snapshot times as wall-clock values, which both engines print alike."""
    return df.withColumn("SnapshotTimestamp", F.col("SnapshotTimestamp").cast("timestamp_ntz"))


# sources -------------------------------------------------------------------------------------


def xml_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    orders = B.table(spark, sf, "orders")
    text = orders.select(record_text(F.struct(*orders.columns), "order").alias("text"))
    return text.select(parse_record(F.col("text"), orders.schema).alias("r")).select("r.*")


def xml_source_file(spark: SparkSession, sf: str) -> DataFrame:
    customers = B.table(spark, sf, "customer")
    path = work_dir(spark, "xml")
    write_records_xml(customers, path, "customer", "customers")
    return read_records_xml(spark, path, customers.schema, "customer")


def _event_lines(spark: SparkSession, sf: str) -> DataFrame:
    ev = B.events(spark, sf)
    path = work_dir(spark, "jsonl")
    write_records_json(ev, path)
    return read_records_json(spark, f"{path}/part-*", ev.schema)


def jsonl_source(spark: SparkSession, sf: str) -> DataFrame:
    return _event_lines(spark, sf)


def profile(spark: SparkSession, sf: str) -> DataFrame:
    """Five files with records and one empty line in a sixth, all of known size."""
    ev = B.events(spark, sf)
    path = work_dir(spark, "profile")
    line = F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(',"event_type":"'), F.col("event_type"), F.lit('"}'))
    ev.select(line.alias("value")).repartition(5).write.text(path)
    spark.range(0, 1, 1, 1).select(F.lit("").alias("value")).write.mode("append").text(path)
    return batch_profile(require_nonempty(read_records_json(spark, path, ev.schema)), path)


def payload_counts(spark: SparkSession, sf: str) -> DataFrame:
    return payload_yield(B.payloads(B.events(spark, sf)), "s", _PAYLOAD_STOP)


def payload_records(spark: SparkSession, sf: str) -> DataFrame:
    records, _ = shred_payloads(B.payloads(B.events(spark, sf)), "s", _PAYLOAD_STOP, key_field="_eva")
    return records.select(
        "request_key",
        F.col("_eva").alias("eva"),
        F.col("_id").alias("id"),
        F.col("tl._c").alias("ttype"),
        F.col("ar._pt").alias("ar_pt"),
        F.col("dp._pt").alias("dp_pt"),
    )


def payload_rejects(spark: SparkSession, sf: str) -> DataFrame:
    _, rejects = shred_payloads(B.payloads(B.events(spark, sf)), "s", _PAYLOAD_STOP)
    return rejects.select("eva", "reason")


def payload_counted(spark: SparkSession, sf: str) -> DataFrame:
    """Records written, and what the same pass has counted."""
    path, seen = work_dir(spark, "counted"), Observation()
    records, _ = shred_payloads(B.payloads(B.events(spark, sf)), "s", _PAYLOAD_STOP, seen=seen)
    records.select("request_key", F.col("_id").alias("id")).write.parquet(path)
    stored = spark.read.parquet(path).agg(F.lit("stored").alias("what"), F.count("*").alias("n"))
    return stored.unionByName(spark.createDataFrame(list(seen.get.items()), "what string, n long"))


# stations --------------------------------------------------------------------------------------


def _clean(spark: SparkSession, sf: str, renewed: bool = False) -> DataFrame:
    raw = B.stations_xml(B.table(spark, sf, "customer"), renewed)
    return clean_stations(raw, B.NEW_FROM if renewed else B.OLD_FROM)


def _old(spark: SparkSession, sf: str) -> DataFrame:
    return B.with_closed(_clean(spark, sf))


def station_clean(spark: SparkSession, sf: str) -> DataFrame:
    return _clean(spark, sf)


def station_asof(spark: SparkSession, sf: str) -> DataFrame:
    return valid_asof(_old(spark, sf), B.AS_OF, MAIN_STATION_SUFFIX)


def request_worklist(spark: SparkSession, sf: str) -> DataFrame:
    return worklist(station_asof(spark, sf), B.AS_OF)


def interval(spark: SparkSession, sf: str) -> DataFrame:
    return scd2_interval(_old(spark, sf), _clean(spark, sf, True), S.STATION_KEY, B.NEW_FROM, OPEN_END)


def _published(spark: SparkSession, sf: str, min_value: int) -> tuple[str, bool]:
    """The closed dimension as first snapshot, then the merged one behind the guard."""
    path = work_dir(spark, "stations")
    create_if_absent(spark, path, S.DIM_STATIONS)
    publish(_old(spark, sf), path)
    merged = scd2_interval(
        read_whole(spark, path, S.DIM_STATIONS), _clean(spark, sf, True), S.STATION_KEY, B.NEW_FROM, OPEN_END
    )
    return path, publish(merged, path, open_main_stations(), min_value)


def guard_pass(spark: SparkSession, sf: str) -> DataFrame:
    path, _ = _published(spark, sf, 1)
    return read_whole(spark, path, S.DIM_STATIONS)


def guard_rollback(spark: SparkSession, sf: str) -> DataFrame:
    path, _ = _published(spark, sf, 10**15)  # no list can have that many stations
    merged = interval(spark, sf)
    return guarded_publish(merged, read_whole(spark, path, S.DIM_STATIONS), open_main_stations(), 10**15)


def snapshot_restore(spark: SparkSession, sf: str) -> DataFrame:
    """Publish two snapshots, then the earlier one again."""
    path, _ = _published(spark, sf, 1)
    earlier = current_snapshot(spark, path) - 1
    publish(read_whole(spark, path, S.DIM_STATIONS, earlier), path)
    return read_whole(spark, path, S.DIM_STATIONS)


def overwrite_reload(spark: SparkSession, sf: str) -> DataFrame:
    """Replace a table by one of another schema."""
    path = work_dir(spark, "overwrite")
    publish(_clean(spark, sf), path)
    narrow = _clean(spark, sf, True).select("eva_number", "station_name", "ValidFrom")
    publish(narrow, path)
    return read_whole(spark, path, narrow.schema)


# plan ----------------------------------------------------------------------------------------


def _plan(ev: DataFrame) -> DataFrame:
    return flatten_planned(B.planned_stops(ev))


def planned_flatten(spark: SparkSession, sf: str) -> DataFrame:
    return _plan(B.events(spark, sf))


def planned_first(spark: SparkSession, sf: str) -> DataFrame:
    return first_planned(B.repeated_plan(_plan(B.events(spark, sf))))


def insert_only(spark: SparkSession, sf: str) -> DataFrame:
    ev = B.events(spark, sf)
    later = _plan(ev).withColumns(
        {c: F.col(c) + 1 for c in ("Arrival_PlannedTime", "Departure_PlannedTime")}
    )
    return merge_insert_only(_plan(B.first_batch(ev)), later, S.PLANNED_KEY)


def unpivot_planned(spark: SparkSession, sf: str) -> DataFrame:
    return planned_events(planned_rows(B.planned_stops(B.events(spark, sf))))


# changes and messages -----------------------------------------------------------------------------


def _changes(ev: DataFrame) -> DataFrame:
    return recent_change_rows(B.changed_stops_json(ev))


def _messages(ev: DataFrame) -> DataFrame:
    return recent_message_rows(B.changed_stops_json(ev))


def change_events(spark: SparkSession, sf: str) -> DataFrame:
    """Every stop landed twice."""
    stops = B.changed_stops_json(B.events(spark, sf))
    return _zone_free(stop_events(stops.unionByName(stops), collected_at(), ""))


def null_changes(spark: SparkSession, sf: str) -> DataFrame:
    stops = B.changed_stops_json(B.events(spark, sf))
    return _zone_free(null_audit(stop_events(stops, collected_at(), ""), "ChangedTime"))


def latest_change(spark: SparkSession, sf: str) -> DataFrame:
    return _zone_free(_changes(B.events(spark, sf)))


def messages_array(spark: SparkSession, sf: str) -> DataFrame:
    return _zone_free(stop_messages(B.changed_stops_xml(B.events(spark, sf)), B.stamp(B.FULL_TS_2)))


def messages_json(spark: SparkSession, sf: str) -> DataFrame:
    stops = B.changed_stops_json(B.events(spark, sf))
    return _zone_free(stop_messages(stops, collected_at(), "", json_text=True))


def latest_message(spark: SparkSession, sf: str) -> DataFrame:
    return _zone_free(_messages(B.events(spark, sf)))


def _two(spark: SparkSession, sf: str, rows: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    ev = B.events(spark, sf)
    return rows(B.first_batch(ev)), rows(B.second_batch(ev))


def deactivate_events(spark: SparkSession, sf: str) -> DataFrame:
    return _zone_free(deactivate(*_two(spark, sf, _changes), S.CHANGED_KEY))


def deactivate_messages(spark: SparkSession, sf: str) -> DataFrame:
    return _zone_free(deactivate(*_two(spark, sf, _messages), S.MESSAGE_KEY))


def _event_history(spark: SparkSession, sf: str) -> DataFrame:
    return scd2_flag_upsert(*_two(spark, sf, _changes), S.CHANGED_KEY)


def upsert_events(spark: SparkSession, sf: str) -> DataFrame:
    return _zone_free(_event_history(spark, sf))


def upsert_messages(spark: SparkSession, sf: str) -> DataFrame:
    return _zone_free(scd2_flag_upsert(*_two(spark, sf, _messages), S.MESSAGE_KEY))


# scalars ---------------------------------------------------------------------------------------


def packed(spark: SparkSession, sf: str) -> DataFrame:
    orders = B.table(spark, sf, "orders").withColumn("packed", pack_time("o_orderdate"))
    return orders.select(
        "o_orderkey", "packed", packed_time("packed").alias("decoded"), batch_name("o_orderdate").alias("batch_name")
    )


def delays(spark: SparkSession, sf: str) -> DataFrame:
    """Arrivals and departures of planned events."""
    ev = B.events(spark, sf)
    changes = _changes(ev).where(~F.col("IsUnplannedEvent")).select("EventId", "EventType", "ChangedTime")
    joined = planned_events(planned_rows(B.planned_stops(ev))).join(changes, ["EventId", "EventType"], "left")
    return joined.select("EventId", "EventType", delay_minutes("PlannedTime", packed_time("ChangedTime")).alias("delay"))


# curated ---------------------------------------------------------------------------------------


def added_baseline(spark: SparkSession, sf: str) -> DataFrame:
    return added_events(_changes(B.events(spark, sf)))


def delay_table(spark: SparkSession, sf: str) -> DataFrame:
    ev = B.events(spark, sf)
    return delay_fact(planned_rows(B.planned_stops(ev)), _changes(ev))


def delay_table_history(spark: SparkSession, sf: str) -> DataFrame:
    return delay_fact(planned_rows(B.planned_stops(B.events(spark, sf))), _event_history(spark, sf))


def _curated(spark: SparkSession, sf: str) -> str:
    """Plan and changes loaded into their tables."""
    base, ev = work_dir(spark, "curated"), B.events(spark, sf)
    load_planned(B.planned_stops(ev), f"{base}/planned")
    for n, part in enumerate((B.first_batch(ev), B.second_batch(ev))):
        load_recent_changes(_jsonl(spark, B.changed_stops_json(part)), f"{base}/changes", f"recent-{n}")
    return base


def delay_table_stored(spark: SparkSession, sf: str) -> DataFrame:
    base = _curated(spark, sf)
    changed = read_active(spark, f"{base}/changes", S.FACT_CHANGED, S.CHANGED_KEY)
    return delay_fact(read_appended(spark, f"{base}/planned", S.FACT_PLANNED), changed)


def delay_table_days(spark: SparkSession, sf: str) -> DataFrame:
    """Two service days of the stored tables."""
    base = _curated(spark, sf)
    planned = read_appended(spark, f"{base}/planned", S.FACT_PLANNED, day=SERVICE_DAY)
    changed = read_active(spark, f"{base}/changes", S.FACT_CHANGED, S.CHANGED_KEY, day=SERVICE_DAY)
    return delay_fact(planned, changed, days=["240102", "240105"])


def delay_table_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """Both stored tables dealt to the same buckets, then joined."""
    base = _curated(spark, sf)
    name = f"haltwerk_{base.rsplit('-', 1)[1]}"
    planned = read_appended(spark, f"{base}/planned", S.FACT_PLANNED)
    changed = read_active(spark, f"{base}/changes", S.FACT_CHANGED, S.CHANGED_KEY)
    sides = [store_bucketed(df, f"{name}_{n}", f"{base}/bucketed-{n}", 8) for n, df in enumerate((planned, changed))]
    return delay_fact(*sides, apart=True)


def cancellation(spark: SparkSession, sf: str) -> DataFrame:
    return kpi_cancellation(delay_table(spark, sf), ["TrainType"])


def ontime_type(spark: SparkSession, sf: str) -> DataFrame:
    return kpi_ontime(delay_table(spark, sf), ["TrainType"])


def ontime_station(spark: SparkSession, sf: str) -> DataFrame:
    return kpi_ontime_by_station(delay_table(spark, sf), _old(spark, sf), date(2024, 3, 1))


def ontime_station_asof(spark: SparkSession, sf: str) -> DataFrame:
    return kpi_ontime_by_station_asof(delay_table(spark, sf), B.station_versions(B.table(spark, sf, "customer")))


def overview(spark: SparkSession, sf: str) -> DataFrame:
    return kpi_overview(delay_table(spark, sf))


# loads -----------------------------------------------------------------------------------------


def _xml(spark: SparkSession, df: DataFrame, schema, tag: str = "s", root: str = "timetable") -> DataFrame:
    """Written as wrapper documents and read back; stop documents by splits."""
    path = work_dir(spark, "raw")
    write_records_xml(df, path, tag, root)
    return read_records_xml(spark, path, schema, tag, root if tag == "s" else None)


def _jsonl(spark: SparkSession, df: DataFrame) -> DataFrame:
    path = work_dir(spark, "raw")
    write_records_json(df, path)
    return read_records_json(spark, f"{path}/part-*", S.CHANGED_JSON)


def stations(spark: SparkSession, sf: str) -> DataFrame:
    path, customers = work_dir(spark, "stations"), B.table(spark, sf, "customer")
    for renewed, day in ((False, B.OLD_FROM), (True, B.NEW_FROM)):
        raw = _xml(spark, B.stations_xml(customers, renewed), S.STATION_XML, "station", "stations")
        for _ in range(2):  # the replay of a batch changes nothing
            load_stations(raw, path, day, min_main_stations=1, batch=str(day))
    return read_whole(spark, path, S.DIM_STATIONS)


def planned(spark: SparkSession, sf: str) -> DataFrame:
    path, ev = work_dir(spark, "planned"), B.events(spark, sf)
    create_if_absent(spark, path, S.FACT_PLANNED)
    again = B.planned_stops(ev)
    for side in ("ar", "dp"):
        again = again.withColumn(side, F.when(F.col(side).isNotNull(), F.col(side).withField("_pp", F.lit("99"))))
    for n, stops in enumerate((B.planned_stops(B.first_batch(ev)), again)):
        load_planned(_xml(spark, stops, S.PLANNED_XML), path, f"load-{n}")
    return read_appended(spark, path, S.FACT_PLANNED)


def _full(spark: SparkSession, sf: str, load: Callable, schema, keys) -> DataFrame:
    path, ev = work_dir(spark, "full"), B.events(spark, sf)
    create_if_absent(spark, path, schema)
    for text, part in ((B.FULL_TS_1, B.first_batch(ev)), (B.FULL_TS_2, B.second_batch(ev))):
        load(_xml(spark, B.changed_stops_xml(part), S.CHANGED_XML), path, B.stamp(text), f"full-{text}")
    return _zone_free(read_history(spark, path, schema, keys))


def _recent(spark: SparkSession, sf: str, load: Callable, schema, keys) -> DataFrame:
    path, ev = work_dir(spark, "recent"), B.events(spark, sf)
    create_if_absent(spark, path, schema)
    for n, part in enumerate((B.first_batch(ev), B.second_batch(ev))):
        load(_jsonl(spark, B.changed_stops_json(part)), path, f"recent-{n}")
    return _zone_free(read_history(spark, path, schema, keys))


def full_changes(spark: SparkSession, sf: str) -> DataFrame:
    return _full(spark, sf, load_full_changes, S.FACT_CHANGED, S.CHANGED_KEY)


def full_messages(spark: SparkSession, sf: str) -> DataFrame:
    return _full(spark, sf, load_full_messages, S.FACT_MESSAGES, S.MESSAGE_KEY)


def recent_changes(spark: SparkSession, sf: str) -> DataFrame:
    return _recent(spark, sf, load_recent_changes, S.FACT_CHANGED, S.CHANGED_KEY)


def recent_messages(spark: SparkSession, sf: str) -> DataFrame:
    return _recent(spark, sf, load_recent_messages, S.FACT_MESSAGES, S.MESSAGE_KEY)


def raw_archive(spark: SparkSession, sf: str) -> DataFrame:
    """Both raw batches kept under their names, the first twice, and both again as two batches of one second and as
    two that share their wall-clock time when clocks go back."""
    path, ev = work_dir(spark, "archive"), B.events(spark, sf)
    first, second = B.changed_stops_json(B.first_batch(ev)), B.changed_stops_json(B.second_batch(ev))
    same = "2024-02-01 10:00:00"
    for raw, name, text in (
        (first, "first", B.FULL_TS_1),
        (second, "second", B.FULL_TS_2),
        (first, "first", B.FULL_TS_1),
        (first, "same-1", same),
        (second, "same-2", same),
        (first, "clock-1", "2024-10-27 00:30:00"),
        (second, "clock-2", "2024-10-27 01:30:00"),
    ):
        archive_raw(raw, path, name, B.stamp(text))
    return spark.read.parquet(path).select("batch_id", "eva", "id", F.col("_collected_at").alias("collected_at"))


def broken_xml(spark: SparkSession, sf: str) -> DataFrame:
    """Wrapper documents with self-closing, open, broken and commented records, and with comments and CDATA sections that
    hold whole records; ids that were read, NULL for broken ones."""
    ev, path = B.events(spark, sf), work_dir(spark, "broken")
    s_id = F.col("event_id").cast("string")
    attributes = F.concat(F.lit(' _id="'), s_id, F.lit('"'))
    kinds = F.element_at(
        F.array(
            F.concat(F.lit("<s"), attributes, F.lit("/>")),
            F.concat(F.lit("<s"), attributes, F.lit("><tl/></s>")),
            F.concat(F.lit("<s"), attributes, F.lit("><ar></s>")),
            F.concat(F.lit("<!-- "), s_id, F.lit(" </s> --><s"), attributes, F.lit("><tl/></s>")),
            F.concat(F.lit("<!-- gone --><s"), attributes, F.lit("/>")),
            F.concat(F.lit('<!-- <s _id="x"><tl/></s><s _id="y"></s> --><s'), attributes, F.lit("><!-- </s> --><tl/></s>")),
            F.concat(F.lit("<s"), attributes, F.lit('><tl><![CDATA[</s><!-- <s _id="z"></s>]]></tl></s>')),
        ),
        (F.col("event_id") % 7 + 1).cast("int"),
    )
    lines = F.array_join(F.array_sort(F.collect_list(kinds)), "")
    head = F.lit('<?xml version="1.0"?><!DOCTYPE timetable [<!ELEMENT s ANY>]><timetable>')
    # One file for each document; so many that their size stays the same, whatever the ids are.
    n = ev.count() // _EVENTS_A_DOCUMENT + 1
    documents = ev.groupBy(F.pmod(F.xxhash64("event_id"), F.lit(n)).alias("d")).agg(F.concat(head, lines, F.lit("</timetable>")).alias("value"))
    documents.select("value").write.option("maxRecordsPerFile", 1).text(path)
    schema = T.StructType([T.StructField("__id", T.StringType())])
    return read_records_xml(spark, path, schema, "s", root_tag="timetable").groupBy(F.col("__id").alias("id")).agg(F.count("*").alias("n"))


def file_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Records with an id, and how many lines had none: broken lines and records without."""
    ev, path = B.events(spark, sf), work_dir(spark, "rejects")
    text = ev.select(
        F.when(F.col("event_type") == "error", F.concat(F.lit('{"id": "'), F.col("event_id").cast("string")))
        .when(F.col("event_type") == "signup", F.lit('{"eva": "1"}'))
        .otherwise(F.concat(F.lit('{"id": "'), F.col("event_id").cast("string"), F.lit('", "eva": "2"}')))
        .alias("value")
    )
    text.write.text(path)
    records, rejects = split_rejects(read_records_json(spark, path, S.CHANGED_JSON))
    return records.groupBy("eva").agg(F.count("*").alias("n")).unionByName(rejects.select(F.lit("rejected").alias("eva"), F.col("n_rejected").alias("n")))


def one_event(spark: SparkSession, sf: str) -> DataFrame:
    """All changes of the first event id."""
    changes = stop_events(B.changed_stops_json(B.events(spark, sf)), collected_at(), "")
    return _zone_free(find_event(changes, changes.agg(F.min("EventId")).head()[0]))


def _half_cut(stops: DataFrame) -> DataFrame:
    half = lambda c: F.when(F.col("eva").cast("long") % 2 == 0, F.concat(F.lit("["), F.col(c))).otherwise(F.col(c))
    return stops.withColumns({"ar": F.col("ar").withField("m", half("ar.m")), "dp": F.col("dp").withField("m", half("dp.m")), "m": half("m")})


def unread_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Every second station's message texts broken."""
    return message_rejects(_half_cut(B.changed_stops_json(B.events(spark, sf))))


def counted_messages(spark: SparkSession, sf: str) -> DataFrame:
    """The same texts counted by the pass that writes the messages."""
    seen = Observation()
    messages = stop_messages(_half_cut(B.changed_stops_json(B.events(spark, sf))), collected_at(), "", json_text=True, seen=seen)
    messages.write.parquet(work_dir(spark, "messages"))
    return spark.createDataFrame([x for x in seen.get.items() if x[1]], "EventType string, n_rejected long")


def upsert_late(spark: SparkSession, sf: str) -> DataFrame:
    """The earlier batch arrives after the later one and must not win."""
    first, second = _two(spark, sf, _changes)
    return _zone_free(scd2_flag_upsert(second, first, S.CHANGED_KEY, guard_late=True))


def history_late(spark: SparkSession, sf: str) -> DataFrame:
    """The same from the stored history."""
    path, ev = work_dir(spark, "late"), B.events(spark, sf)
    for part in (B.second_batch(ev), B.first_batch(ev)):
        load_recent_changes(B.changed_stops_json(part), path)
    return _zone_free(read_history(spark, path, S.FACT_CHANGED, S.CHANGED_KEY, guard_late=True))


def interval_reopen(spark: SparkSession, sf: str) -> DataFrame:
    return scd2_interval(_old(spark, sf), _clean(spark, sf, True), S.STATION_KEY, B.NEW_FROM, OPEN_END, reopen=True)


def sql_views(spark: SparkSession, sf: str) -> DataFrame:
    """Views registered over empty tables, which loads and two batches of the stream then fill; queried in SQL."""
    base, ev, customers = work_dir(spark, "views"), B.events(spark, sf), B.table(spark, sf, "customer")
    register_views(spark, f"{base}/stations", f"{base}/planned", f"{base}/changes", f"{base}/messages")
    together(
        spark,
        lambda: load_stations(B.stations_xml(customers), f"{base}/stations", B.OLD_FROM, min_main_stations=1),
        lambda: load_planned(B.planned_stops(ev), f"{base}/planned"),
        lambda: _streamed(spark, sf, base),
    )
    return spark.sql(
        """
        SELECT v.EventType, count(*) AS n_events, count_if(v.IsCancelled) AS n_cancelled,
               count(s.eva_number) AS n_main, sum(coalesce(m.n, 0)) AS n_messages
        FROM v_traindelayfact v
        LEFT JOIN dim_stations s ON CAST(s.eva_number AS STRING) = v.EVA_Number AND s.station_name LIKE '%Hbf'
        LEFT JOIN (SELECT EventId, EventType, count(*) AS n FROM fact_messages WHERE IsActive GROUP BY ALL) m
          ON m.EventId = v.EventId AND m.EventType = v.EventType
        GROUP BY v.EventType
        """
    )


# streaming -----------------------------------------------------------------------------------------


def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    base = work_dir(spark, "ingest")
    write_records_json(B.changed_stops_json(B.events(spark, sf)), f"{base}/landing")
    (
        ingest_stream(spark, f"{base}/landing", archive=f"{base}/archive")
        .writeStream.format("parquet")
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{base}/out")
        .awaitTermination()
    )
    return spark.read.schema(S.CHANGED_JSON).parquet(f"{base}/out").select(
        "eva", "id", F.col("_collected_at").alias("collected_at"), F.col("ar.ct").alias("ar_ct"), F.col("dp.ct").alias("dp_ct")
    )


def _streamed(spark: SparkSession, sf: str, base: str | None = None) -> str:
    """Two arrivals of files, each followed by one run of the stream."""
    base, ev = base or work_dir(spark, "stream"), B.events(spark, sf)
    for part in (B.first_batch(ev), B.second_batch(ev)):
        # Dealt out while rows are small: events lie in order of time, so a batch is in few row groups, however many cores there are.
        B.changed_stops_json(part.repartition("event_id", "user_id", "ts")).write.mode("append").json(f"{base}/landing")
        scd2_stream(
            ingest_stream(spark, f"{base}/landing", archive=f"{base}/archive"),
            f"{base}/changes",
            f"{base}/messages",
            f"{base}/checkpoint",
        ).awaitTermination()
    return base


def stream_events(spark: SparkSession, sf: str) -> DataFrame:
    return _zone_free(read_history(spark, f"{_streamed(spark, sf)}/changes", S.FACT_CHANGED, S.CHANGED_KEY, guard_late=True))


def stream_messages(spark: SparkSession, sf: str) -> DataFrame:
    return _zone_free(read_history(spark, f"{_streamed(spark, sf)}/messages", S.FACT_MESSAGES, S.MESSAGE_KEY, guard_late=True))


def stream_late_files(spark: SparkSession, sf: str) -> DataFrame:
    """The earlier batch arrives in a later file; its flags are right without a guard at the reader."""
    base, ev = work_dir(spark, "late-stream"), B.events(spark, sf)
    for part in (B.second_batch(ev), B.first_batch(ev)):
        B.changed_stops_json(part).write.mode("append").json(f"{base}/landing")
        for query in late_safe_stream(ingest_stream(spark, f"{base}/landing"), f"{base}/changes", f"{base}/messages", f"{base}/checkpoint"):
            query.awaitTermination()
    return _zone_free(read_history(spark, f"{base}/changes", S.FACT_CHANGED, S.CHANGED_KEY))


def stream_retired(spark: SparkSession, sf: str) -> DataFrame:
    """Three arrivals. After two runs the first has gone, and the third, which came after them, stays; a run later the second goes. Nothing is lost."""
    base, ev = work_dir(spark, "retired"), B.events(spark, sf)

    def arrive(n: int) -> None:
        B.changed_stops_json(ev.where(F.col("event_id") % 3 == n)).write.mode("append").json(f"{base}/landing")

    def run() -> None:
        ingest = ingest_stream(spark, f"{base}/landing", archive=f"{base}/archive").writeStream.format("parquet")
        ingest.option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start(f"{base}/out").awaitTermination()

    def state(step: int) -> DataFrame:
        read = spark.read.schema(S.CHANGED_JSON).parquet(f"{base}/out").agg(F.lit("read").alias("place"), F.count("*").alias("n_records"))
        places = ingest_state(spark, f"{base}/landing", f"{base}/archive").select("place", "n_records")
        # Files go on: what stands now is kept before the next run.
        path = work_dir(spark, "retired-state")
        places.unionByName(read).withColumn("step", F.lit(step)).write.parquet(path)
        return spark.read.parquet(path)

    arrive(0)
    run()
    arrive(1)
    run()
    arrive(2)
    before = state(1)
    run()
    return before.unionByName(state(2))


def queries() -> dict[str, Query]:
    return {
        "xml_roundtrip": xml_roundtrip,
        "xml_source_file": xml_source_file,
        "jsonl_source": jsonl_source,
        "batch_profile": profile,
        "payload_yield": payload_counts,
        "payload_records": payload_records,
        "payload_rejects": payload_rejects,
        "request_worklist": request_worklist,
        "station_clean": station_clean,
        "station_asof": station_asof,
        "null_audit": null_changes,
        "planned_flatten": planned_flatten,
        "planned_first": planned_first,
        "change_events": change_events,
        "latest_change": latest_change,
        "messages_array": messages_array,
        "messages_json": messages_json,
        "latest_message": latest_message,
        "merge_insert_only": insert_only,
        "scd2_interval": interval,
        "scd2_deactivate_events": deactivate_events,
        "scd2_deactivate_messages": deactivate_messages,
        "scd2_upsert_events": upsert_events,
        "scd2_upsert_messages": upsert_messages,
        "guard_pass": guard_pass,
        "guard_rollback": guard_rollback,
        "snapshot_restore": snapshot_restore,
        "overwrite_reload": overwrite_reload,
        "packed_time": packed,
        "delay_minutes": delays,
        "unpivot_planned": unpivot_planned,
        "added_baseline": added_baseline,
        "delay_fact": delay_table,
        "delay_fact_history": delay_table_history,
        "delay_fact_stored": delay_table_stored,
        "delay_fact_bucketed": delay_table_bucketed,
        "kpi_cancellation": cancellation,
        "kpi_ontime_type": ontime_type,
        "kpi_ontime_station": ontime_station,
        "kpi_ontime_station_asof": ontime_station_asof,
        "kpi_overview": overview,
        "load_stations": stations,
        "load_planned": planned,
        "load_full_changes": full_changes,
        "load_recent_changes": recent_changes,
        "load_full_messages": full_messages,
        "load_recent_messages": recent_messages,
        "raw_archive": raw_archive,
        "sql_views": sql_views,
        "xml_broken_records": broken_xml,
        "file_rejects": file_rejects,
        "find_event": one_event,
        "message_rejects": unread_messages,
        "scd2_upsert_late": upsert_late,
        "load_late_changes": history_late,
        "scd2_interval_reopen": interval_reopen,
        "delay_fact_day": delay_table_days,
        "payload_counted": payload_counted,
        "messages_counted": counted_messages,
        "stream_late_files": stream_late_files,
        "stream_retired": stream_retired,
        "stream_ingest": stream_ingest,
        "stream_scd2_events": stream_events,
        "stream_scd2_messages": stream_messages,
    }
