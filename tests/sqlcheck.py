"""Compares a query with its SQL on DuckDB."""

from __future__ import annotations

import os


def connect(folder: str):
    duckdb = __import__("pytest").importorskip("duckdb")
    con = duckdb.connect()
    for f in os.listdir(folder):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{folder}/{f}'")
    return con


def plain(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if v != v else float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v.isoformat() if hasattr(v, "isoformat") else v


def assert_same(df, con, sql: str) -> None:
    rows = df.collect()
    rel = con.sql(sql)
    cols = rel.columns
    assert sorted(df.columns) == sorted(cols)
    left = sorted(repr([plain(r[c]) for c in sorted(df.columns)]) for r in rows)
    at = [cols.index(c) for c in sorted(cols)]
    right = sorted(repr([plain(r[i]) for i in at]) for r in rel.fetchall())
    assert left == right
