"""Compare a Spark result with DuckDB SQL over the same files."""

from __future__ import annotations

import datetime
import math
from pathlib import Path

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            connection.execute(
                f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
            )
    return connection


def _key(row: tuple) -> tuple:
    return tuple((value is not None, str(type(value)), value) for value in row)


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=_key)


def differences(spark_df, connection, sql: str) -> str | None:
    """None if both give the same columns and the same rows (in any order), else what differs."""
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    expected = rows_of(names, result.fetchall())
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} and {sorted(names)}"
    actual = rows_of(spark_df.columns, [tuple(row) for row in spark_df.collect()])
    if len(actual) != len(expected):
        return f"{len(actual)} rows and {len(expected)} expected"
    for mine, theirs in zip(actual, expected):
        if mine != theirs:
            return f"{mine} and {theirs} expected"
    return None
