"""Compares registered queries with their plain-SQL answers, run by DuckDB on the same files."""

from __future__ import annotations

import math

import duckdb
from pyspark.sql import DataFrame

from churnflow.sources.views import TABLES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    normalised = [tuple(normal(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(normalised, key=repr)


def difference(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both sides agree on column names, kinds of values and every row."""
    expected = connection.execute(sql)
    names = [d[0] for d in expected.description]
    want = sorted_rows(names, expected.fetchall())
    got = sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    if want[0] != got[0]:
        return f"columns {got[0]} instead of {want[0]}"
    if len(want[1]) != len(got[1]):
        return f"{len(got[1])} rows instead of {len(want[1])}"
    for a, b in zip(got[1], want[1]):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{a} instead of {b}"
    return None
