"""Compare a Spark result with DuckDB's: columns, row count and values, in any row order."""

from __future__ import annotations

import datetime
import decimal
import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{Path(sf_dir) / t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, (datetime.datetime, datetime.date, decimal.Decimal)):
        return str(v)
    return repr(v)


def normalized(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return (
        [columns[i] for i in order],
        sorted(tuple(plain(r[i]) for i in order) for r in rows),
    )


def differences(df, con, sql: str) -> str | None:
    """Null when both sides agree, else a short description."""
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    want_cols = [d[0] for d in cur.description]
    want_rows = cur.fetchall()
    cols, got = normalized(df.columns, rows)
    wcols, want = normalized(want_cols, want_rows)
    if cols != wcols:
        return f"columns {cols} against {wcols}"
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}: {got[:2]} {want[:2]}"
    for a, b in zip(got, want):
        if a != b:
            return f"{a} against {b}"
    return None
