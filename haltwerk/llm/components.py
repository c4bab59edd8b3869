"""Connected components of a graph whose edges do not fit one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of ``edges`` (a long, b long): the label is the least node it can reach.

    Alternates two steps until nothing changes: every node joins its larger neighbours, then its smaller ones, to the least
    node it sees. A node with very many neighbours sends one minimum to each; minima are combined before the shuffle.
    Each round is written to the shared folder. Rounds grow with the logarithm of the longest path.
    """
    now = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    mark = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        large = both.join(least, F.col("u") == F.col("w")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), "m")
        small = large.join(least, F.col("u") == F.col("w")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = staged(small.union(least.select(F.col("w").alias("u"), F.col("m").alias("v"))).distinct(), "edges")
        after = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head()
        if tuple(after) == mark:
            break
        mark = tuple(after)
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).union(roots.select("node", F.col("node").alias("label")))
