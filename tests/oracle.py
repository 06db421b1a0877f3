"""Comparison of a query's result with its SQL oracle."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def duck(sf_dir: str):
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _value(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else round(v, 9)
    return str(v) if hasattr(v, "isoformat") else v


def _bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


def compare(df, con, sql) -> tuple[str, int]:
    """('' or what differs, number of rows)."""
    rows = df.collect()
    if sql is None:
        return "", len(rows)
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}", len(rows)
    ours, theirs = _bag(df.columns, rows), _bag(columns, result.fetchall())
    if ours != theirs:
        extra, lacking = ours - theirs, theirs - ours
        return f"extra {list(extra)[:2]} lacking {list(lacking)[:2]}", len(rows)
    return "", len(rows)
