"""Run a registered Spark query and its DuckDB oracle on one scale; compare.

Same gate as the driver: row count, column names, and the multiset of rows
(order-insensitive). Decimals compare exactly, doubles to 1e-9 relative.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return ("~null",)
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, decimal.Decimal):
        return ("n", format(v.normalize(), "f") if v == v else "nan")
    if isinstance(v, float):
        if math.isnan(v):
            return ("n", "nan")
        return ("n", format(decimal.Decimal(repr(v)).normalize(), "f"))
    if isinstance(v, int):
        return ("n", str(v))
    if isinstance(v, dt.datetime):
        return ("d", v.date().isoformat() if v.time() == dt.time() else v.isoformat())
    if isinstance(v, dt.date):
        return ("d", v.isoformat())
    return ("s", str(v))


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, name: str, fn, sql: str, sf_dir: str, con=None) -> dict:
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    con = con or duck_connection(sf_dir)
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    out = {"query": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "columns_match": sorted(s_cols) == sorted(d_cols)}
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    out["values_match"] = a == b
    if not out["values_match"]:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        out["first_diffs"] = diff
        out["cols"] = (s_cols, d_cols)
    return out
