"""Times this library's plans against the plain multi-scan form of the same step.

Both forms read the same raw files and give the same rows. The plain form reads its input
once per branch and unions the branches; it is what a direct SQL statement of the step
does on Spark. Prints one JSON line: {step: [plain seconds, library seconds]}.
"""

from __future__ import annotations

import json
import os
import time
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haltwerk import schemas as S
from haltwerk.harness import bindings as B
from haltwerk.operators import stop_events, stop_messages
from haltwerk.plans import collected_at, planned_events, planned_rows
from haltwerk.session import local_session, work_dir
from haltwerk.sources import read_records_json, read_records_xml, write_records_json, write_records_xml

SIDES = {"Arrival": "ar", "Departure": "dp"}


def plain_events(stops: DataFrame) -> DataFrame:
    def branch(label: str, test, distinct: bool = False) -> DataFrame:
        side = SIDES.get(label)
        pick = (lambda n: F.col(f"{side}.{n}")) if side else (lambda n: F.lit(None).cast("string"))
        rows = stops.where(test).select(
            F.col("eva").cast("long"), "id", collected_at(), F.lit(label), pick("clt").cast("long"), pick("cp"),
            pick("ct").cast("long"), pick("l"), pick("cs"), F.coalesce(pick("cs") == "a", F.lit(False)), F.lit(True),
        )
        return rows.distinct() if distinct else rows

    ar, dp = F.col("ar").isNotNull(), F.col("dp").isNotNull()
    parts = [branch("Arrival", ar), branch("Departure", dp), branch("Stop", ~ar & ~dp, distinct=True)]
    return reduce(DataFrame.union, parts).toDF(*S.FACT_CHANGED.names)


def plain_messages(stops: DataFrame) -> DataFrame:
    def branch(label: str, text: str) -> DataFrame:
        msg = stops.where(F.col(text).isNotNull()).select(
            "eva", "id", collected_at().alias("at"), F.explode(F.from_json(text, S.MESSAGES_JSON)).alias("m")
        )
        sent, stop = F.col("m.ts").cast("long"), label == "Stop"
        return msg.select(
            F.col("eva").cast("long"), "id", F.lit(label), "at", "m.id", "m.t", sent,
            F.col("m.cat") if stop else F.lit(None).cast("string"),
            F.col("m.from").cast("long") if stop else sent, F.col("m.to").cast("long") if stop else sent, F.lit(True),
        )

    parts = [branch("Arrival", "ar.m"), branch("Departure", "dp.m"), branch("Stop", "m")]
    return reduce(DataFrame.union, parts).toDF(*S.FACT_MESSAGES.names)


def plain_unpivot(plan: DataFrame) -> DataFrame:
    def branch(label: str) -> DataFrame:
        time_text = F.lpad(F.col(f"{label}_PlannedTime").cast("string"), 10, "0")
        return plan.where(F.col(f"{label}_PlannedTime").isNotNull()).select(
            "EVA_Number", "EventId", "TrainName", "TrainType", F.lit(label),
            F.to_timestamp_ntz(time_text, F.lit("yyMMddHHmm")),
            *(f"{label}_{c}" for c in ("PlannedPlatform", "IsReplaced", "ReplacementType")),
        )

    return branch("Arrival").union(branch("Departure"))


def seconds(df: DataFrame) -> float:
    best = None
    for _ in range(3):
        start = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        took = time.perf_counter() - start
        best = took if best is None else min(best, took)
    return round(best, 2)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    copies = int(os.environ.get("BENCH_COPIES", "8"))
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("shapes", cpus)
    spark.sparkContext.setLogLevel("ERROR")
    base, ev = work_dir(spark, "shapes"), B.events(spark, sf_dir)
    many = reduce(DataFrame.unionByName, [ev] * copies)
    write_records_json(B.changed_stops_json(many), f"{base}/json")
    write_records_xml(B.changed_stops_xml(many).coalesce(1), f"{base}/xml", "s", "timetable", 10**9)
    planned_rows(B.planned_stops(many)).write.parquet(f"{base}/plan")

    stops = read_records_json(spark, f"{base}/json/part-*", S.CHANGED_JSON)
    plan = spark.read.schema(S.FACT_PLANNED).parquet(f"{base}/plan")
    steps = {
        "events": (plain_events(stops), stop_events(stops, collected_at(), "", distinct_stops=False)),
        "events_distinct": (plain_events(stops), stop_events(stops, collected_at(), "")),
        "messages": (plain_messages(stops), stop_messages(stops, collected_at(), "", json_text=True)),
        "unpivot": (plain_unpivot(plan), planned_events(plan)),
        "xml_one_file": (
            read_records_xml(spark, f"{base}/xml", S.CHANGED_XML, "s"),
            read_records_xml(spark, f"{base}/xml", S.CHANGED_XML, "s", "timetable"),
        ),
    }
    print(json.dumps({"stops": many.count(), **{n: [seconds(a), seconds(b)] for n, (a, b) in steps.items()}}))


if __name__ == "__main__":
    main()
