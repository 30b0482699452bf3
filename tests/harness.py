"""Run a query on Spark and its SQL on DuckDB, and compare the rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def canonical(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    shaped = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(shaped, key=repr)


def difference(spark, folder, fn, sql, connection) -> str | None:
    """None when both results agree, else a short account of the difference."""
    frame = fn(spark, folder)
    got_names, got = canonical([tuple(r) for r in frame.collect()], frame.columns)
    cursor = connection.execute(sql)
    want_names, want = canonical(cursor.fetchall(), [c[0] for c in cursor.description])
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)} rows"
    wrong = [(a, b) for a, b in zip(got, want) if repr(a) != repr(b)]
    if wrong:
        return f"{len(wrong)} of {len(got)} rows differ, first: {wrong[0]}"
    return None
