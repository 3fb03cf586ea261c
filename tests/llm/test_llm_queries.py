"""Registration, and the SQL twins on the given tables."""

import compare
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tavola.llm import queries

FOLDER = f"{compare.DATA}/sf0.001"


def test_one_query_for_each_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.queries())
    assert numbers == list(range(1, 14))
    assert set(queries.oracle_sql()) <= set(queries.queries())
    assert "pipeline" in entry.queries()


def test_stages_are_in_the_given_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near_copies", "benchmark", "tokens"]


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_sql(spark, name):
    frame = queries.queries()[name](spark, FOLDER)
    assert compare.differences(frame, compare.connect(FOLDER), queries.oracle_sql()[name]) == []
