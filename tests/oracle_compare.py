"""Compare a Spark query with its DuckDB oracle on the same parquet tables."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits: int = 6):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, digits) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), digits) + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def compare(spark_df, con, sql: str, digits: int = 6) -> dict:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    o_cols = [d[0] for d in res.description]
    o_rows = res.fetchall()
    out = {"spark_rows": len(s_rows), "oracle_rows": len(o_rows),
           "cols_match": sorted(s_cols) == sorted(o_cols)}
    if not out["cols_match"]:
        out["spark_only"] = sorted(set(s_cols) - set(o_cols))
        out["oracle_only"] = sorted(set(o_cols) - set(s_cols))
        out["match"] = False
        return out
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    oi = [o_cols.index(c) for c in order]
    a = sorted((tuple(_norm(r[i], digits) for i in si) for r in s_rows), key=_key)
    b = sorted((tuple(_norm(r[i], digits) for i in oi) for r in o_rows), key=_key)
    out["match"] = a == b
    if not out["match"]:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        out["first_diffs"] = [(dict(zip(order, x)), dict(zip(order, y))) for x, y in diff]
    return out
