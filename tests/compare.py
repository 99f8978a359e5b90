"""Run queries next to their SQL and compare rows, column names and values."""

from __future__ import annotations

import datetime
import decimal
import math
import os
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        path = f"{sf_dir}/{table}.parquet"
        if os.path.exists(path):
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, datetime.datetime):
        return value.date().isoformat() if value.time() == datetime.time() else value.isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def spark_rows(df) -> tuple[list[str], Counter]:
    return sorted(df.columns), rows_of(df.columns, df.collect())


def sql_rows(connection, text: str) -> tuple[list[str], Counter]:
    result = connection.execute(text)
    columns = [d[0] for d in result.description]
    return sorted(columns), rows_of(columns, result.fetchall())


def difference(df, connection, text: str) -> str | None:
    """None when equal, else a short description."""
    columns, found = spark_rows(df)
    expected_columns, expected = sql_rows(connection, text)
    if columns != expected_columns:
        return f"columns {columns} vs {expected_columns}"
    if found != expected:
        extra, lacking = found - expected, expected - found
        return (
            f"{sum(found.values())} vs {sum(expected.values())} rows; "
            f"only here {list(extra.items())[:2]}; only in SQL {list(lacking.items())[:2]}"
        )
    return None
