"""Comparison of Spark results with DuckDB on the same parquet tables."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for p in Path(root).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return con


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, float):
        return float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def rows_of(columns: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return [columns[k] for k in order], Counter(tuple(plain(r[k]) for k in order) for r in rows)


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """'' if both agree, else what differs."""
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    rel = con.execute(sql)
    want = rows_of([c[0] for c in rel.description], rel.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} and {want[0]}"
    a, b = got[1] - want[1], want[1] - got[1]
    return f"{sum(a.values())} rows only in Spark, {sum(b.values())} only in DuckDB: {list(a)[:2]} and {list(b)[:2]}" if a or b else ""
