"""The test tables seen as timetable data.

Every binding derives its rows one by one from a whole table: no row is left out, and no
group is collected into one row. The same rules are stated in SQL in ``oracle.py``.

Stop ids have the form ``<trip>-<yyMMddHHmm>-1``; several events describe one stop.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import OPEN_END

BATCH_CUT = "2024-01-20"  # events before it are the first batch
FULL_TS_1, FULL_TS_2 = "2024-01-20 00:00:00", "2024-01-31 00:00:00"
OLD_FROM, NEW_FROM = date(2024, 1, 1), date(2024, 9, 1)
AS_OF = date(2024, 7, 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def stamp(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def _cut() -> Column:
    return F.lit(BATCH_CUT).cast("timestamp_ntz")


def first_batch(ev: DataFrame) -> DataFrame:
    return ev.where(F.col("ts") < _cut())


def second_batch(ev: DataFrame) -> DataFrame:
    return ev.where(F.col("ts") >= _cut())


_TRIP = "(user_id * 24 + event_id % 24)"  # a user's events fall on 24 stops and return to them at scattered times
_STOP_ID = (
    f"concat({_TRIP}, '-', "
    f"date_format(date_add(DATE'2024-01-01', CAST({_TRIP} % 7 AS INT)), 'yyMMdd'), '0000-1')"
)


def _packed(minutes: str) -> str:
    return f"date_format(ts + make_dt_interval(0, 0, {minutes}), 'yyMMddHHmm')"


# planned stops ---------------------------------------------------------------------------


def _planned(ev: DataFrame) -> DataFrame:
    """The stop's own fields and the event's columns; scalars first, then structs."""
    scalars = ev.selectExpr(
        "event_id",
        "user_id",
        "event_type",
        "value",
        f"{_STOP_ID} AS _id",
        "concat(event_type, ' ', user_id) AS _fb",
        "CASE WHEN event_id % 8 = 0 THEN NULL WHEN value < 20 THEN concat(event_type, ' ', user_id) "
        "ELSE CAST(user_id AS STRING) END AS _l",
        "CAST(event_id % 12 + 1 AS STRING) AS _pp",
        f"{_packed('0')} AS arrives",
        f"{_packed('5')} AS departs",
    )
    return scalars.selectExpr(
        "event_id",
        "user_id",
        "event_type",
        "value",
        "_id",
        "struct(event_type AS _c) AS tl",
        "CASE WHEN event_type <> 'signup' THEN struct(_fb, _l, _pp, arrives AS _pt) END AS ar",
        "CASE WHEN event_type <> 'error' THEN struct(_fb, _l, _pp, departs AS _pt) END AS dp",
    )


def planned_stops(ev: DataFrame) -> DataFrame:
    """One raw planned stop per event (schema ``PLANNED_XML``)."""
    return _planned(ev).selectExpr("CAST(user_id AS STRING) AS _eva", "_id", "tl", "ar", "dp")


def repeated_plan(planned: DataFrame) -> DataFrame:
    """Every plan row twice; the second copy has no times on platform 1, else times one higher."""
    timeless = F.coalesce("Arrival_PlannedPlatform", "Departure_PlannedPlatform") == "1"
    again = planned.withColumns(
        {
            c: F.when(~timeless, F.col(c) + 1)
            for c in ("Arrival_PlannedTime", "Departure_PlannedTime")
        }
    )
    return planned.unionByName(again)


# changed stops ---------------------------------------------------------------------------


def _changed(ev: DataFrame, prefix: str, as_text: bool) -> DataFrame:
    # Scalars once, then message lists, then the stop: no expression is repeated.
    shift = "CAST(floor(value) AS INT) - 30"
    scalars = ev.selectExpr(
        "event_id % 4 AS kind",
        "event_id",
        "event_type",
        "value",
        "ts",
        "CAST(user_id AS STRING) AS eva",
        f"{_STOP_ID} AS stop",
        f"{_packed('0')} AS now",
        f"{_packed('1')} AS now_1",
        f"{_packed('60')} AS until",
        f"{_packed('61')} AS until_1",
        f"{_packed(shift)} AS ct_ar",
        f"{_packed(shift + ' + 2')} AS ct_dp",
        "concat('L', user_id % 50) AS line",
        "CASE event_type WHEN 'error' THEN 'c' WHEN 'signup' THEN 'a' END AS status",
    )

    def message(k: int, tail: str) -> str:
        return (
            f"struct(concat('r', (event_id + {k}) % 3) AS {prefix}id, substr(event_type, 1, 1) AS {prefix}t, "
            f"now{tail} AS {prefix}ts, event_type AS {prefix}cat, now{tail} AS {prefix}from, until{tail} AS {prefix}to)"
        )

    one, two = f"array({message(0, '')})", f"array({message(0, '')}, {message(1, '_1')})"
    text = "to_json" if as_text else ""
    lists = scalars.selectExpr(
        "*",
        f"{text}(CASE WHEN event_type = 'click' THEN {two} WHEN event_type <> 'view' THEN {one} END) AS beside",
        f"{text}(CASE WHEN kind = 3 OR event_type = 'purchase' THEN {one} END) AS alone",
    )

    def side(time: str) -> str:
        return (
            f"struct(CASE WHEN event_type = 'error' THEN now END AS {prefix}clt, "
            f"CASE WHEN event_type = 'click' THEN CAST(event_id % 5 AS STRING) END AS {prefix}cp, "
            f"CASE WHEN event_type <> 'view' THEN {time} END AS {prefix}ct, "
            f"line AS {prefix}l, status AS {prefix}cs, beside AS m)"
        )

    stamp = ["date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\") AS _collected_at"] if as_text else []
    return lists.selectExpr(
        f"eva AS {prefix}eva",
        f"stop AS {prefix}id",
        f"CASE WHEN kind <= 1 OR (kind = 3 AND value > 50) THEN {side('ct_ar')} END AS ar",
        f"CASE WHEN kind = 0 OR kind = 2 THEN {side('ct_dp')} END AS dp",
        "alone AS m",
        *stamp,
    )


def changed_stops_xml(ev: DataFrame) -> DataFrame:
    """One raw changed stop per event (schema ``CHANGED_XML``)."""
    return _changed(ev, "_", as_text=False)


def changed_stops_json(ev: DataFrame) -> DataFrame:
    """The same stops as ``CHANGED_JSON``: message lists as text, with collection time."""
    return _changed(ev, "", as_text=True)


# payloads ----------------------------------------------------------------------------------


def payloads(ev: DataFrame) -> DataFrame:
    """One landed response per event with none to three planned stops inside.

    ``error`` events failed; bodies of expensive clicks are cut off.
    """
    stops = _planned(ev).select("*", F.struct("_id", "tl", "ar", "dp").alias("stop"))
    body = F.to_xml(
        F.struct(F.array_repeat("stop", (F.col("event_id") % 4).cast("int")).alias("s")), {"rowTag": "timetable"}
    )
    cut = (F.col("event_type") == "click") & (F.col("value") > 100)
    return stops.select("user_id", "event_type", cut.alias("cut"), body.alias("body")).select(
        F.col("user_id").alias("eva"),
        F.when(F.col("event_type") == "error", 503).otherwise(200).alias("status"),
        F.when(F.col("cut"), F.substring_index("body", ">", 1)).otherwise(F.col("body")).alias("body"),
    )


# stations ----------------------------------------------------------------------------------


def stations_xml(customers: DataFrame, renewed: bool = False) -> DataFrame:
    """One raw station per customer (schema ``STATION_XML``).

    In the renewed list every seventh station has given way to one with a new number.
    """
    number = "CASE WHEN c_custkey % 7 = 0 THEN c_custkey + 1000000000 ELSE c_custkey END" if renewed else "c_custkey"
    return customers.selectExpr(
        f"CAST({number} AS STRING) AS _eva",
        "substr(c_mktsegment, 1, 4) AS _ds100",
        "concat(c_name, CASE WHEN c_custkey % 2 = 0 THEN ' Hbf' WHEN c_custkey % 3 = 0 THEN ' Hbf (tief)' ELSE '' END) "
        "AS _name",
        "CAST(c_custkey % 100 AS STRING) AS _meta",
        "CASE WHEN c_acctbal > 0 THEN 'true' ELSE 'false' END AS _db",
        "CASE WHEN c_custkey % 11 <> 0 THEN CAST(c_nationkey AS STRING) END AS _creationts",
        "CAST(NULL AS STRING) AS _updatets",
    )


def with_closed(dim: DataFrame) -> DataFrame:
    """Every fifth station was closed on 2024-06-01."""
    return dim.withColumn(
        "ValidTo",
        F.when(F.col("eva_number") % 5 == 1, F.lit(date(2024, 6, 1))).otherwise(F.lit(OPEN_END)),
    )


def station_versions(customers: DataFrame) -> DataFrame:
    """Two versions of every station: renamed on 2024-01-16; every fifth was closed from the 10th on until then, every third has not come back."""
    first = customers.selectExpr(
        "c_custkey AS eva_number",
        "c_name AS station_name",
        "DATE'2024-01-01' AS ValidFrom",
        "CASE WHEN c_custkey % 5 = 1 THEN DATE'2024-01-10' ELSE DATE'2024-01-16' END AS ValidTo",
    )
    second = customers.where("c_custkey % 3 <> 2").selectExpr(
        "c_custkey AS eva_number", "concat(c_name, ' Hbf') AS station_name", "DATE'2024-01-16' AS ValidFrom", "DATE'9999-12-31' AS ValidTo"
    )
    return first.unionByName(second)
