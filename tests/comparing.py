"""Comparison of a Spark result with its SQL counterpart in DuckDB."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(folder: str):
    """DuckDB with all given tables as views."""
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0) if value != 0 else "0.0"
    return str(value)


def rows_of(columns: list[str], rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(df, connection, sql: str) -> str | None:
    """None when both sides hold the same columns and rows."""
    result = connection.execute(sql)
    expected_columns = [column[0] for column in result.description]
    expected = rows_of(expected_columns, result.fetchall())
    actual = rows_of(df.columns, [tuple(row) for row in df.collect()])
    if sorted(df.columns) != sorted(expected_columns):
        return f"columns {sorted(df.columns)} != {sorted(expected_columns)}"
    if len(actual) != len(expected):
        return f"{len(actual)} rows != {len(expected)}"
    for mine, theirs in zip(actual, expected, strict=True):
        if mine != theirs:
            return f"{mine} != {theirs}"
    return None
