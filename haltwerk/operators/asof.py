"""Join of rows with the version that is valid on each row's own day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Keys that the rows of one key are dealt to; every version goes to each.
SALTS = 16


def join_asof(
    rows: DataFrame, versions: DataFrame, key: str, day: str, values: Sequence[str], start: str = "ValidFrom", end: str = "ValidTo", salts: int = SALTS
) -> DataFrame:
    """``rows`` with ``values`` of the version of their ``key`` that is valid on their ``day`` (start included, end excluded), else NULL.

    Rows and versions are united, sorted by key and day, and the last version is carried on to the rows behind it, so the work grows with both
    sides and not with their product, however many versions a key has. Versions of a key do not overlap; of those that start
    together the longest counts. A NULL key or day finds nothing. Rows of a hot key are dealt to ``salts`` tasks.
    """
    spread = F.xxhash64(*(F.col(f"`{c}`") for c in rows.columns))
    salt = F.when(F.col(key).isNull(), spread).otherwise(F.pmod(spread, F.lit(salts)))
    left = rows.withColumns({"__at": F.col(day).cast("date"), "__salt": salt, "__is_row": F.lit(True)})
    right = versions.where(F.col(key).isNotNull() & F.col(start).isNotNull()).select(
        F.col(key),
        F.col(start).cast("date").alias("__at"),
        F.struct(F.col(end).cast("date").alias("until"), *values).alias("__version"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("__salt"),
        F.lit(False).alias("__is_row"),
    )
    until = F.col("__version.until").asc_nulls_first()
    order = Window.partitionBy(key, "__salt").orderBy(F.col("__at").asc_nulls_first(), "__is_row", until).rowsBetween(Window.unboundedPreceding, 0)
    carried = left.unionByName(right, allowMissingColumns=True).withColumn("__last", F.last("__version", ignorenulls=True).over(order))
    valid = F.col("__last.until") > F.col("__at")
    return carried.where("__is_row").select(*(F.col(f"`{c}`") for c in rows.columns), *(F.when(valid, F.col(f"__last.{v}")).alias(v) for v in values))
