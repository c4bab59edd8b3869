"""Explicit schemas of raw records and tables; nothing is inferred from data.

Raw numeric attributes are declared as strings and decoded with ``try_cast`` later:
one malformed number then costs that field, not the whole record.
"""

from __future__ import annotations

from pyspark.sql import types as T

_TEXT, _LONG, _BOOL, _DATE, _TIME = T.StringType(), T.LongType(), T.BooleanType(), T.DateType(), T.TimestampType()


def _struct(*texts: str, **typed: T.DataType) -> T.StructType:
    """String fields by name, then fields of other types."""
    fields = [(name, _TEXT) for name in texts] + list(typed.items())
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


# raw records

STATION_XML = _struct("_eva", "_ds100", "_name", "_meta", "_db", "_creationts", "_updatets")

_PLANNED_SIDE = _struct("_fb", "_l", "_pp", "_pt")
PLANNED_XML = _struct("_eva", "_id", tl=_struct("_c"), ar=_PLANNED_SIDE, dp=_PLANNED_SIDE)

# One message type for all three lists. Arrival and departure messages carry no
# category or validity; those members simply stay NULL there.
_MESSAGES_XML = T.ArrayType(_struct("_id", "_t", "_ts", "_cat", "_from", "_to"))
_CHANGED_SIDE_XML = _struct("_clt", "_cp", "_ct", "_l", "_cs", m=_MESSAGES_XML)
CHANGED_XML = _struct("_eva", "_id", ar=_CHANGED_SIDE_XML, dp=_CHANGED_SIDE_XML, m=_MESSAGES_XML)

MESSAGES_JSON = T.ArrayType(_struct("id", "t", "ts", "cat", "from", "to"))
_CHANGED_SIDE_JSON = _struct("clt", "cp", "ct", "l", "cs", "m")
CHANGED_JSON = _struct("id", "eva", "_collected_at", "m", ar=_CHANGED_SIDE_JSON, dp=_CHANGED_SIDE_JSON)

# Tables. Names and order of their columns.

DIM_STATIONS = T.StructType(
    [
        T.StructField("eva_number", _LONG),
        T.StructField("ds100_code", _TEXT),
        T.StructField("station_name", _TEXT),
        T.StructField("meta_stations", _TEXT),
        T.StructField("is_db_station", _BOOL),
        T.StructField("creation_timestamp", _TEXT),
        T.StructField("ValidFrom", _DATE),
        T.StructField("ValidTo", _DATE),
    ]
)

FACT_PLANNED = T.StructType(
    [
        T.StructField("EVA_Number", _TEXT),
        T.StructField("EventId", _TEXT),
        T.StructField("TrainType", _TEXT),
        T.StructField("TrainName", _TEXT),
        T.StructField("Arrival_IsReplaced", _TEXT),
        T.StructField("Arrival_ReplacementType", _TEXT),
        T.StructField("Arrival_ReplacementName", _TEXT),
        T.StructField("Arrival_PlannedPlatform", _TEXT),
        T.StructField("Arrival_PlannedTime", _LONG),
        T.StructField("Departure_IsReplaced", _TEXT),
        T.StructField("Departure_ReplacementType", _TEXT),
        T.StructField("Departure_ReplacementName", _TEXT),
        T.StructField("Departure_PlannedPlatform", _TEXT),
        T.StructField("Departure_PlannedTime", _LONG),
    ]
)

FACT_CHANGED = T.StructType(
    [
        T.StructField("eva_number", _LONG),
        T.StructField("EventId", _TEXT),
        T.StructField("SnapshotTimestamp", _TIME),
        T.StructField("EventType", _TEXT),
        T.StructField("CancellationTime", _LONG),
        T.StructField("ChangedPlatform", _TEXT),
        T.StructField("ChangedTime", _LONG),
        T.StructField("TrainName", _TEXT),
        T.StructField("EventStatus", _TEXT),
        T.StructField("IsUnplannedEvent", _BOOL),
        T.StructField("IsActive", _BOOL),
    ]
)

FACT_MESSAGES = T.StructType(
    [
        T.StructField("eva_number", _LONG),
        T.StructField("EventId", _TEXT),
        T.StructField("EventType", _TEXT),
        T.StructField("SnapshotTimestamp", _TIME),
        T.StructField("MessageId", _TEXT),
        T.StructField("MessageType", _TEXT),
        T.StructField("MessageTime", _LONG),
        T.StructField("MessageCategory", _TEXT),
        T.StructField("MessageValidFrom", _LONG),
        T.StructField("MessageValidTo", _LONG),
        T.StructField("IsActive", _BOOL),
    ]
)

PLANNED_KEY = ["EventId"]
STATION_KEY = ["eva_number", "creation_timestamp"]
CHANGED_KEY = ["EventId", "EventType", "IsUnplannedEvent"]
MESSAGE_KEY = ["EventId", "EventType", "MessageId"]

PAYLOAD = T.StructType(
    [T.StructField("eva", _LONG), T.StructField("status", T.IntegerType()), T.StructField("body", _TEXT)]
)
