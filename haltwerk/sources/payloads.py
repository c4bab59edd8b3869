"""Landed responses: one row per request with its status and XML body."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DOC, _HAS = "__doc", "__has"
_CORRUPT = "_corrupt_record"
_STATUS_OK = 200


def _parsed(payloads: DataFrame, row_tag: str, record: T.StructType) -> DataFrame:
    document = T.StructType(
        [T.StructField(row_tag, T.ArrayType(record)), T.StructField(_CORRUPT, T.StringType())]
    )
    body = F.when(_ok(), F.col("body"))  # a failed response is not parsed
    # Made by a generator: a filter on what was parsed stays above it, and neither parses a body nor builds it once more.
    return payloads.select("*", F.inline(F.array(F.struct(F.from_xml(body, document.simpleString()).alias(_DOC), F.col("body").isNotNull().alias(_HAS)))))


def _ok() -> Column:
    return F.coalesce(F.col("status") == _STATUS_OK, F.lit(False))


def _readable() -> Column:
    return _ok() & F.col(_HAS) & F.col(f"{_DOC}.{_CORRUPT}").isNull()


def shred_payloads(
    payloads: DataFrame,
    row_tag: str,
    record: T.StructType,
    request_key: str = "eva",
    key_field: str | None = None,
    seen: Observation | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(records, rejects).

    Records carry the request key beside the payload's own fields; ``key_field`` also
    writes it over that field of the record. Rejects are failed or unreadable responses
    with a reason. A readable body without records is neither. ``seen`` counts requests, failed, malformed and
    records while the records are written, without a second read.
    """
    parsed = _parsed(payloads, row_tag, record)
    counted = parsed.observe(seen, *_counts(row_tag)) if seen else parsed
    fields = [
        (F.col(request_key).cast("string") if f == key_field else F.col(f"__rec.{f}")).alias(f)
        for f in record.fieldNames()
    ]
    records = (
        counted.where(_readable())
        .select(request_key, F.explode(f"{_DOC}.{row_tag}").alias("__rec"))
        .select(F.col(request_key).alias("request_key"), *fields)
    )
    reason = F.when(_ok(), F.lit("malformed")).otherwise(
        F.concat(F.lit("status "), F.coalesce(F.col("status").cast("string"), F.lit("missing")))
    )
    rejects = parsed.where(~_readable()).withColumn("reason", reason).drop(_DOC, _HAS)
    return records, rejects


def _counts(row_tag: str) -> list[Column]:
    n = F.when(_readable(), F.coalesce(F.size(F.col(f"{_DOC}.{row_tag}")), F.lit(0))).otherwise(0)
    return [
        F.count(F.lit(1)).alias("requests"),
        F.count_if(~_ok()).alias("failed"),
        F.count_if(_ok() & ~_readable()).alias("malformed"),
        F.sum(F.greatest(n, F.lit(0))).alias("records"),  # size of a missing list is -1 outside ANSI mode
    ]


def payload_yield(payloads: DataFrame, row_tag: str, record: T.StructType, request_key: str = "eva") -> DataFrame:
    """Requests, failures, unreadable bodies and records per request key, in one pass."""
    return _parsed(payloads, row_tag, record).groupBy(request_key).agg(*_counts(row_tag))
