"""Compare queries with their SQL, row by row and without regard to order."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """A connection with a view per given table."""
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    return connection


def _value(value: object) -> object:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    return value if value is None else str(value)


def rows_of_spark(df: DataFrame) -> Counter:
    names = sorted(df.columns)
    return Counter(tuple((n, _value(row[n])) for n in names) for row in df.collect())


def rows_of_sql(connection: duckdb.DuckDBPyConnection, sql: str) -> Counter:
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    rows = (dict(zip(names, row, strict=True)) for row in cursor.fetchall())
    return Counter(tuple((n, _value(row[n])) for n in sorted(names)) for row in rows)


def differences(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs, a few examples of each kind; empty when equal."""
    ours, theirs = rows_of_spark(df), rows_of_sql(connection, sql)
    found = []
    for label, rows in (("only in Spark", ours - theirs), ("only in SQL", theirs - ours)):
        found += [f"{label} ({rows.total()}): {dict(row)}" for row in list(rows)[:2]]
    return found
