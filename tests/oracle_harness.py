"""Spark-vs-DuckDB comparison in the way the driver grades it: same row
count, same column names, and the same multiset of rows (columns sorted by
name, order-insensitive)."""

from __future__ import annotations

import math
import os

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return repr(round(v, 9))
    if hasattr(v, "isoformat"):
        return str(pd.Timestamp(v).tz_localize(None) if getattr(v, "tzinfo", None) else pd.Timestamp(v))
    try:
        import decimal
        if isinstance(v, decimal.Decimal):
            return repr(round(float(v), 9))
    except Exception:
        pass
    if isinstance(v, (list, tuple)):
        return str([_norm(x) for x in v])
    return str(v)


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    rows = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(rows, key=lambda t: tuple((x is None, x or "") for x in t)), [cols[i] for i in order]


def compare(spark_df, con, sql: str) -> dict:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    a, ac = rows_of(s_cols, s_rows)
    b, bc = rows_of(d_cols, d_rows)
    out = {"spark_rows": len(a), "oracle_rows": len(b), "schema_ok": ac == bc,
           "values_ok": a == b}
    if not out["schema_ok"]:
        out["spark_cols"], out["oracle_cols"] = ac, bc
    elif not out["values_ok"]:
        sa, sb = set(a), set(b)
        out["only_spark"] = list(sa - sb)[:3]
        out["only_oracle"] = list(sb - sa)[:3]
    return out
