"""Tables dealt to buckets by their key, for joins that are made again and again."""

from __future__ import annotations

from pyspark.sql import DataFrame


def store_bucketed(df: DataFrame, name: str, path: str, buckets: int, key: str = "EventId") -> DataFrame:
    """``df`` as the catalogue's table ``name`` below ``path``, one sorted file for each bucket of ``key``.

    Tables of as many buckets meet on the key without a shuffle of either (with more join columns than the key this needs
    ``spark.sql.requireAllClusterKeysForCoPartition=false``). The table is replaced as a whole; write it from ``read_active`` and
    ``read_appended`` after their loads.
    """
    dealt = df.repartition(buckets, key)
    dealt.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)
