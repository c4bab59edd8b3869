"""Compare a Spark query with its SQL statement on the same tables."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v


def rows(names, data) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in data)


def difference(spark, con, query, sql: str, sf_dir: str) -> str | None:
    """None if both give the same rows, else what differs."""
    df = query(spark, sf_dir)
    got = rows(df.columns, df.collect())
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = rows(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if got != want:
        return (
            f"rows {sum(got.values())} vs {sum(want.values())}; only Spark {list((got - want).items())[:2]}; "
            f"only SQL {list((want - got).items())[:2]}"
        )
    return None if got else "no rows"
