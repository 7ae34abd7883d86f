"""Runs a query and its SQL on the same tables and compares the rows."""

from __future__ import annotations

import math

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return f"{value:.6f}"
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return str(value)


def _normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(con, df, sql: str) -> list[str]:
    """What differs, empty if the results are equal."""
    columns, rows = _normal(df.columns, df.collect())
    result = con.execute(sql)
    want_columns, want = _normal([d[0] for d in result.description], result.fetchall())
    problems = []
    if columns != want_columns:
        problems.append(f"columns {columns} != {want_columns}")
    if len(rows) != len(want):
        problems.append(f"rows {len(rows)} != {len(want)}")
    if not problems and rows != want:
        pairs = [(a, b) for a, b in zip(rows, want) if a != b]
        problems.append(f"{len(pairs)} rows differ, first {pairs[0]}")
    return problems
