"""A corpus from raw documents to token ids: five stages, each reading what the last one wrote.

1. ``quality`` drops the documents that a quality rule rejects.
2. ``lines`` deletes later copies of line runs of 50 words and more.
3. ``near_copies`` keeps one document of each group linked by a similarity of 0.8 of their
   five-word shingles.
4. ``benchmark`` drops the documents that hold a benchmark item.
5. ``tokens`` encodes the texts that are left: doc_id, n_tokens, ids, and digests of the ids and
   of the text decoded from them.

All but the last stage return the columns of their input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tavola.llm import bpe, decontaminate, jaccard, linededup, quality
from tavola.llm.shared import stored
from tavola.llm.tables import benchmark, documents


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def without_line_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return linededup.drop_copies(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_first(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(docs, benchmark(spark, sf_dir))


def as_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(docs)


STAGES = [
    ("quality", good_documents),
    ("lines", without_line_copies),
    ("near_copies", one_of_each_group),
    ("benchmark", without_benchmark),
    ("tokens", as_tokens),
]

#: SQL cannot express the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; every stage is written to the shared folder and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
