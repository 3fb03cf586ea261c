from __future__ import annotations

import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tavola-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tavola-warehouse-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make(spark):
    """Build a model table from tuples, in the order of its declared columns."""
    from tavola.sources.schemas import schema_of

    def build(table, rows, columns=None):
        schema = schema_of(table)
        names = columns or schema.names
        filled = [dict(zip(names, row)) for row in rows]
        return spark.createDataFrame(
            [tuple(row.get(name) for name in schema.names) for row in filled], schema
        )

    return build


@pytest.fixture(scope="session")
def by_key():
    """Rows of a frame as dicts, by the value of one column."""

    def index(df, key):
        return {row[key]: row.asDict() for row in df.collect()}

    return index
