"""Spark result vs. DuckDB oracle: row count, column names and values (order-insensitive)."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

from tessera.sources.tables import TABLES


def duck(data_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{data_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return v
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _key(row):
    return tuple((x is None, str(type(x).__name__), str(x)) for x in row)


def compare(spark_df, con, sql: str):
    s_cols = spark_df.columns
    s_rows = [tuple(_norm(x) for x in r) for r in spark_df.collect()]
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_rows = [tuple(_norm(x) for x in r) for r in rel.fetchall()]
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns spark={s_cols} duck={d_cols}")
        return problems
    order = [d_cols.index(c) for c in s_cols]
    d_rows = [tuple(r[i] for i in order) for r in d_rows]
    if len(s_rows) != len(d_rows):
        problems.append(f"rows spark={len(s_rows)} duck={len(d_rows)}")
    a, b = sorted(s_rows, key=_key), sorted(d_rows, key=_key)
    diffs = [(x, y) for x, y in zip(a, b) if x != y]
    if diffs:
        problems.append(f"{len(diffs)} differing rows, first: spark={diffs[0][0]} duck={diffs[0][1]}")
    return problems
