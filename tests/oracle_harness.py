"""Compare a registered Spark query with its DuckDB oracle.

Columns are matched by name (sorted), rows compared as an order-insensitive
multiset of exact values, as the round's correctness gate does.
"""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import duckdb

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def spark_rows(df):
    cols = df.columns
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    rows = [tuple(_norm(r[i]) for i in order) for r in df.collect()]
    return [cols[i] for i in order], rows


def duck_rows(con, sql):
    rel = con.sql(sql)
    cols = rel.columns
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    rows = [tuple(_norm(r[i]) for i in order) for r in rel.fetchall()]
    return [cols[i] for i in order], rows


def compare(spark_df, con, sql) -> tuple[bool, str]:
    s_cols, s_rows = spark_rows(spark_df)
    d_cols, d_rows = duck_rows(con, sql)
    if s_cols != d_cols:
        return False, f"columns differ: spark={s_cols} oracle={d_cols}"
    if len(s_rows) != len(d_rows):
        return False, f"row count differs: spark={len(s_rows)} oracle={len(d_rows)}"
    cs, cd = Counter(s_rows), Counter(d_rows)
    if cs != cd:
        only_s = list((cs - cd).elements())[:3]
        only_d = list((cd - cs).elements())[:3]
        return False, f"values differ ({len(s_rows)} rows): spark-only={only_s} oracle-only={only_d}"
    return True, f"{len(s_rows)} rows"
