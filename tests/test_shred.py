from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from haltwerk import schemas as S
from haltwerk.operators import flatten_planned, message_rejects, stop_events, stop_messages
from haltwerk.plans import collected_at
from haltwerk.sources import read_records_xml, shred_payloads

NOW = datetime(2024, 7, 11, 6, 0)

XML = """<?xml version="1.0" encoding="UTF-8"?>
<timetable>
<s id="both" eva="1"><ar ct="2407110541" cp="7D" l="RE1"><m id="x" t="h" ts="2407110500"/></ar><dp cs="c" clt="2407110542"/></s>
<s id="added" eva="1"><dp cs="a" ct="2407110700"><m id="y" t="d" ts="2407110501"/><m id="z" t="d" ts="2407110502"/></dp></s>
<s id="bare" eva="1"><m id="w" t="h" ts="2407110503" cat="Info" from="2407110400" to="2407110800"/></s>
<s id="bare" eva="1"/>
<s id="badnum" eva="x"><ar ct="late"/></s>
</timetable>
"""


def changed(spark, tmp_path):
    (tmp_path / "a.xml").write_text(XML)
    return read_records_xml(spark, str(tmp_path), S.CHANGED_XML, "s")


def test_events_from_xml(spark, tmp_path, rows):
    got = rows(
        stop_events(changed(spark, tmp_path), F.lit(NOW)),
        "EventId", "EventType", "eva_number", "ChangedTime", "ChangedPlatform", "EventStatus", "IsUnplannedEvent",
    )
    assert got == sorted(
        [
            ("added", "Departure", 1, 2407110700, None, "a", True),
            ("badnum", "Arrival", None, None, None, None, False),
            ("bare", "Stop", 1, None, None, None, False),
            ("both", "Arrival", 1, 2407110541, "7D", None, False),
            ("both", "Departure", 1, None, None, "c", False),
        ],
        key=lambda r: [(v is not None, str(v)) for v in r],
    )


def test_stop_rows_may_stay_double_until_dedup(spark, tmp_path):
    stops = changed(spark, tmp_path)
    assert stop_events(stops, F.lit(NOW)).count() == 5
    assert stop_events(stops, F.lit(NOW), distinct_stops=False).count() == 6


def test_no_arrival_in_the_batch(spark, tmp_path):
    (tmp_path / "b.xml").write_text('<t><s id="q" eva="1"><dp ct="2407110700"/></s></t>')
    stops = read_records_xml(spark, str(tmp_path), S.CHANGED_XML, "s")
    assert [r["EventType"] for r in stop_events(stops, F.lit(NOW)).collect()] == ["Departure"]
    assert stop_messages(stops, F.lit(NOW)).count() == 0


def test_messages_from_xml(spark, tmp_path, rows):
    got = rows(
        stop_messages(changed(spark, tmp_path), F.lit(NOW)),
        "MessageId", "EventType", "MessageTime", "MessageCategory", "MessageValidFrom", "MessageValidTo",
    )
    assert got == [
        ("w", "Stop", 2407110503, "Info", 2407110400, 2407110800),
        ("x", "Arrival", 2407110500, None, 2407110500, 2407110500),
        ("y", "Departure", 2407110501, None, 2407110501, 2407110501),
        ("z", "Departure", 2407110502, None, 2407110502, 2407110502),
    ]


def test_message_text_forms(spark, rows):
    def stop(i, text):
        return Row(id=str(i), eva="1", _collected_at="2024-07-11T06:00:00+00:00", m=text, ar=None, dp=None)

    texts = ['[{"id":"a"},{"id":"b"}]', '{"id":"c"}', "[{broken", "", None, "[]"]
    stops = spark.createDataFrame([stop(i, t) for i, t in enumerate(texts)], S.CHANGED_JSON)
    got = rows(stop_messages(stops, collected_at(), "", json_text=True), "EventId", "MessageId")
    assert got == [("0", "a"), ("0", "b"), ("1", "c")]
    assert rows(message_rejects(stops)) == [("Stop", 2)]


def test_departure_only_stop_has_no_name(spark, rows):
    stops = spark.createDataFrame(
        [Row(_eva="1", _id="o", tl=None, ar=None, dp=("ICE 7", "RE 1", "3", "2407110500"))], S.PLANNED_XML
    )
    columns = ("TrainName", "Arrival_IsReplaced", "Departure_IsReplaced", "Departure_ReplacementName")
    assert rows(flatten_planned(stops), *columns) == [(None, "NO", "YES", "7")]
    assert rows(flatten_planned(stops, name_from_departure=True), "TrainName") == [("ICE 7",)]


def test_payloads(spark, rows):
    stop = '<s id="{0}"><dp pt="{1}"/></s>'
    data = [
        (1, 200, "<t>" + stop.format("a", 5) + stop.format("b", "x") + "</t>"),
        (2, 200, "<t>" + stop.format("c", 6) + "</t>"),
        (3, 200, "<t/>"),
        (4, 200, "<t><s id="),
        (5, 200, None),
        (6, 500, "<t>" + stop.format("d", 7) + "</t>"),
        (7, None, None),
    ]
    payloads = spark.createDataFrame(data, S.PAYLOAD)
    records, rejects = shred_payloads(payloads, "s", S.PLANNED_XML, key_field="_eva")
    assert rows(records, "request_key", "_eva", "_id", "dp._pt") == [
        (1, "1", "a", "5"), (1, "1", "b", "x"), (2, "2", "c", "6"),
    ]
    assert rows(rejects, "eva", "reason") == [
        (4, "malformed"), (5, "malformed"), (6, "status 500"), (7, "status missing"),
    ]


@pytest.mark.parametrize("split_bytes", [None, 64])
def test_wrapper_document_can_be_split(spark, tmp_path, rows, split_bytes):
    (tmp_path / "a.xml").write_text(XML)
    (tmp_path / "b.xml").write_text('<timetable station="X"/>')
    (tmp_path / "c.xml").write_text('<timetable><s id="1"/><s id="2"/></timetable>')
    whole = read_records_xml(spark, str(tmp_path), S.CHANGED_XML, "s")
    default = spark.conf.get("spark.sql.files.maxPartitionBytes")
    if split_bytes:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        split = read_records_xml(spark, str(tmp_path), S.CHANGED_XML, "s", "timetable")
        assert split_bytes is None or split.rdd.getNumPartitions() > 5
        assert rows(split) == rows(whole)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", default)


def test_broken_record_in_a_split_document(spark, tmp_path, rows):
    (tmp_path / "a.xml").write_text('<timetable><s id="1"><ar/></s><s id="2"><ar></s><s id="3"><dp/></s></timetable>')
    split = read_records_xml(spark, str(tmp_path), S.CHANGED_XML, "s", "timetable")
    assert rows(split, "_id") == [(None,), ("1",), ("3",)]
