"""Every query that has a SQL twin gives the same rows on an independent engine."""

import pytest

import __spark_entry__ as entry
import compare
from tavola.plans import catalog, oracle

FOLDER = f"{compare.DATA}/sf0.001"
QUERIES, ORACLE = catalog.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return compare.connect(FOLDER)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, duck, name):
    frame = QUERIES[name](spark, FOLDER)
    assert compare.differences(frame, duck, ORACLE[name]) == []


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
