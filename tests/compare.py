"""Comparison of a Spark result with DuckDB's, without regard to row order."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{os.path.join(sf_dir, name)}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 4) + 0.0
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_value(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(out, key=lambda r: [(x is not None, str(x)) for x in r])


def differences(df, con, sql: str) -> str | None:
    """None where both agree in columns, types of value and rows, else what differs first."""
    got_names, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.sql(sql)
    want_names, want = _rows(result.columns, result.fetchall())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    for g, w in zip(got, want):
        if g != w or [type(x) for x in g] != [type(x) for x in w]:
            return f"row\n  got  {str(g)[:1500]}\n  want {str(w)[:1500]}"
    return None
