"""Compare a Spark result with DuckDB, column by column and row by row."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')"
        )
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def spark_rows(df):
    return sorted(df.columns), _rows(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(connection, sql):
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    return sorted(names), _rows(names, result.fetchall())
