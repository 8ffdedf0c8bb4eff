"""Comparison of a Spark result with the rows DuckDB computes from the same files."""

from __future__ import annotations

import math
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


# DuckDB type names by the name of the Spark type; decimals have the same name in both.
DUCKDB_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "float": "FLOAT",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, Decimal):
        return ("decimal", str(value))
    return (type(value).__name__, repr(value))


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def assert_same(df, connection, sql: str) -> int:
    cursor = connection.execute(sql)
    expected_columns = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    for name, kind in df.dtypes:
        assert DUCKDB_TYPES.get(kind, kind.upper()) == types[name], f"type of {name}: {kind} against {types[name]}"
    expected = cursor.fetchall()
    assert sorted(df.columns) == sorted(expected_columns)
    actual = [tuple(row) for row in df.collect()]
    assert len(actual) == len(expected)
    left, right = _rows(df.columns, actual), _rows(expected_columns, expected)
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    assert not wrong, f"{len(wrong)} of {len(left)} rows differ, first (spark, sql): {wrong[0]}"
    return len(actual)
