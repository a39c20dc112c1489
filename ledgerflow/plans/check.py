"""Side-by-side check of a Spark query and its DuckDB oracle SQL.

Rows are compared as sorted tuples after normalising floats (rounded to 6
places), decimals (to float) and dates/timestamps (to ISO text), with
columns matched by name.
"""
from __future__ import annotations

import datetime as dt
import decimal
import os

from ledgerflow.sources.tables import DRIVER_TABLES


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def duckdb_rows(sql: str, sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in DRIVER_TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    rel = con.sql(sql)
    cols = rel.columns
    return cols, rel.fetchall()


def compare(df, sql: str, sf_dir: str) -> dict:
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    d_cols, d_rows = duckdb_rows(sql, sf_dir)
    out = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "schema_match": sorted(s_cols) == sorted(d_cols)}
    if not out["schema_match"]:
        out["spark_cols"], out["oracle_cols"] = s_cols, d_cols
        out["match"] = False
        return out
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    key = lambda r: tuple((x is None, str(x)) for x in r)
    a = sorted((tuple(_norm(r[i]) for i in si) for r in s_rows), key=key)
    b = sorted((tuple(_norm(r[i]) for i in di) for r in d_rows), key=key)
    out["match"] = a == b
    if not out["match"]:
        diff_a = [r for r in a if r not in set(b)][:3]
        diff_b = [r for r in b if r not in set(a)][:3]
        out["only_spark"], out["only_oracle"], out["columns"] = diff_a, diff_b, order
    return out
