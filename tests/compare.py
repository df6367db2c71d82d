"""Comparison of a Spark result with DuckDB's, by column name and regardless of row order."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "conversations")


def oracle(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _key(row: tuple) -> tuple:
    return tuple((value is not None, str(type(value)), str(value)) for value in row)


def spark_rows(rows: DataFrame) -> tuple[list[str], list[tuple]]:
    names = sorted(rows.columns)
    return names, sorted((tuple(r) for r in rows.select(*names).collect()), key=_key)


def oracle_rows(connection: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    result = connection.execute(sql)
    columns = [c[0] for c in result.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    data = [tuple(row[i] for i in order) for row in result.fetchall()]
    return sorted(columns), sorted(data, key=_key)


def kinds(row: tuple) -> tuple:
    """Broad type of each value, so that 1, 1.0 and True are told apart."""
    return tuple(
        None
        if v is None
        else next(k for k in (bool, int, float, str, dt.datetime, dt.date) if isinstance(v, k))
        for v in row
    )
