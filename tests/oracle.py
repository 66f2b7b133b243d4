"""Local stand-in for the driver's correctness gate.

Runs a Spark query and its DuckDB oracle SQL on the same parquet tables and
compares row count, column names and an order-insensitive value hash.
"""

from __future__ import annotations

import hashlib
import os
import math

import duckdb

from folio.sources.tables import TABLES, table_path


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v) if os.environ.get("FOLIO_EXACT_FLOATS") else repr(round(v, 9))
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if hasattr(v, "asDict"):
        return _norm(tuple(v))
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    return str(v)


def digest(columns: list[str], rows: list[tuple]) -> tuple[int, list[str], str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("\x1f".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return len(rows), sorted(columns), h


def compare(spark, sf_dir: str, query, sql: str) -> dict:
    sdf = query(spark, sf_dir)
    s_rows = [tuple(r) for r in sdf.collect()]
    s = digest(sdf.columns, s_rows)
    con = duck(sf_dir)
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    d = digest(d_cols, d_rows)
    out = {
        "rows_spark": s[0],
        "rows_oracle": d[0],
        "columns_match": s[1] == d[1],
        "values_match": s[2] == d[2],
    }
    if not (out["columns_match"] and out["values_match"]):
        out["spark_columns"] = s[1]
        out["oracle_columns"] = d[1]
        # first differing line for debugging
        order_s = sorted(range(len(sdf.columns)), key=lambda i: sdf.columns[i])
        order_d = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
        ls = sorted("\x1f".join(_norm(r[i]) for i in order_s) for r in s_rows)
        ld = sorted("\x1f".join(_norm(r[i]) for i in order_d) for r in d_rows)
        diff_s = [x for x in ls if x not in set(ld)][:2]
        diff_d = [x for x in ld if x not in set(ls)][:2]
        out["only_spark"] = [x[:400] for x in diff_s]
        out["only_oracle"] = [x[:400] for x in diff_d]
    return out
