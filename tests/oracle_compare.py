"""Compare a Spark result with a DuckDB oracle result."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _key(row):
    return tuple((v is None, str(type(v).__name__) if v is not None else "", v if v is not None else 0) for v in row)


def _same(a, b, exact: bool = False) -> bool:
    if a is None or b is None:
        return a is b
    if isinstance(a, float) or isinstance(b, float):
        if exact:
            return float(a) == float(b)
        return math.isclose(float(a), float(b), rel_tol=1e-12, abs_tol=1e-12)
    return a == b


def compare(spark_df, con, sql: str, exact: bool = False, ordered: bool = False) -> tuple[bool, str]:
    """(equal?, message). Columns are matched by name, rows as multisets, or in order with ``ordered``."""
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_rows = rel.fetchall()
    s_cols = spark_df.columns
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={s_cols} oracle={d_cols}"
    s_rows = [tuple(_norm(r[c]) for c in sorted(s_cols)) for r in spark_df.collect()]
    idx = [d_cols.index(c) for c in sorted(s_cols)]
    d_rows = [tuple(_norm(r[i]) for i in idx) for r in d_rows]
    if len(s_rows) != len(d_rows):
        return False, f"row counts differ: spark={len(s_rows)} oracle={len(d_rows)}"
    if not ordered:
        s_rows.sort(key=_key)
        d_rows.sort(key=_key)
    for a, b in zip(s_rows, d_rows):
        if len(a) != len(b) or not all(_same(x, y, exact) for x, y in zip(a, b)):
            return False, f"first differing row: spark={a} oracle={b}"
    return True, f"{len(s_rows)} rows equal"
