"""Comparison of a query result with its SQL in DuckDB."""

from __future__ import annotations

import glob
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        if glob.glob(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _rows(columns: list[str], rows) -> list[str]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str, allow_empty: bool = False) -> str | None:
    """None if the rows are equal (any order, exact values), else what differs."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected_rows = cursor.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    actual = _rows(df.columns, [tuple(r) for r in df.collect()])
    expected = _rows(names, expected_rows)
    if len(actual) != len(expected):
        return f"{len(actual)} rows != {len(expected)} rows"
    wrong = [(a, e) for a, e in zip(actual, expected) if a != e]
    if wrong:
        return f"{len(wrong)} of {len(actual)} rows differ; {sorted(names)}; first: {wrong[0]}"
    if not actual and not allow_empty:
        return "both results are empty"
    return None
