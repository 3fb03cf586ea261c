"""Run a query on Spark and its SQL twin on DuckDB and compare them exactly."""

from __future__ import annotations

import os

import duckdb

DATA = "/root/testdata"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Spark type -> DuckDB type that holds the same values.
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        path = os.path.join(folder, f"{table}.parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return connection


def _sorted(rows):
    return sorted(rows, key=lambda row: tuple((x is None, str(type(x)), x) for x in row))


def differences(frame, connection, sql: str) -> list[str]:
    """What differs in column names, types, row count or values; empty when equal."""
    names = sorted(frame.columns)
    spark_types = {f.name: f.dataType.simpleString() for f in frame.schema}
    relation = connection.execute(sql)
    duck_types = {d[0]: str(d[1]) for d in relation.description}
    if sorted(duck_types) != names:
        return [f"columns {names} != {sorted(duck_types)}"]
    found = [
        f"type of {n}: {spark_types[n]} != {duck_types[n]}"
        for n in names
        if TYPES.get(spark_types[n], spark_types[n]) != duck_types[n]
    ]
    order = [list(duck_types).index(n) for n in names]
    expected = _sorted(tuple(row[i] for i in order) for row in relation.fetchall())
    actual = _sorted(tuple(row[n] for n in names) for row in frame.collect())
    if len(actual) != len(expected):
        found.append(f"rows {len(actual)} != {len(expected)}")
    bad = [(a, e) for a, e in zip(actual, expected) if a != e]
    if bad:
        found.append(f"{len(bad)} rows differ, first {bad[0]}")
    return found
