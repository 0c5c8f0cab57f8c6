"""Compare registered queries with their SQL in DuckDB."""

from __future__ import annotations

import math

import duckdb

from fundsieve.fixtures import TABLES


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def cell(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "tzinfo") and v.tzinfo is not None:
        v = v.replace(tzinfo=None)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(cell(r[i]) for i in order) for r in rows), key=repr)


def differ(spark, con, f, sql, sf_dir):
    """None if both give the same rows, else what differs."""
    df = f(spark, sf_dir)
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    got = con.execute(sql)
    theirs = rows_of([d[0] for d in got.description], got.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} and {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"{len(ours[1])} and {len(theirs[1])} rows"
    bad = [(a, b) for a, b in zip(ours[1], theirs[1], strict=True) if a != b]
    return f"{len(bad)} rows differ, as {bad[0]}" if bad else None
