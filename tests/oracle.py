"""Side-by-side comparison of a Spark result with its SQL twin."""

from __future__ import annotations

import datetime
import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{Path(sf_dir) / t}.parquet')")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else (0.0 if v == 0 else v)
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    return v


def kind(v) -> str:
    return type(v).__name__


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return names, sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def compare(df, con, sql: str) -> list[str]:
    """Differences in words; empty when both sides agree."""
    s_names, s_rows = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    d_names, d_rows = rows_of([c[0] for c in result.description], result.fetchall())
    if s_names != d_names:
        return [f"columns {s_names} vs {d_names}"]
    if len(s_rows) != len(d_rows):
        return [f"rows {len(s_rows)} vs {len(d_rows)}"]
    bad = [(a, b) for a, b in zip(s_rows, d_rows, strict=True) if a != b]
    types = [
        f"{n}: {kind(a)} vs {kind(b)}"
        for r, d in zip(s_rows[:50], d_rows[:50], strict=True)
        for n, a, b in zip(s_names, r, d, strict=True)
        if a is not None and b is not None and kind(a) != kind(b)
    ]
    return sorted(set(types)) + ([f"{len(bad)} of {len(s_rows)} rows differ, first {bad[0]}"] if bad else [])
