from __future__ import annotations

import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest


@pytest.fixture()
def folder(tmp_path):
    """Write small tables as Parquet files and give their folder."""

    def write(**tables: pa.Table) -> str:
        for name, table in tables.items():
            pq.write_table(table, os.path.join(tmp_path, f"{name}.parquet"))
        return str(tmp_path)

    return write


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) pairs, with columns that clash with names used inside."""

    def build(rows):
        return spark.createDataFrame(
            [(i, t, "en", "s", len(t or ""), 7, "x", "y") for i, t in rows],
            "doc_id long, text string, lang string, source string, n_chars long, "
            "part int, kept string, `a.b` string",
        )

    return build
