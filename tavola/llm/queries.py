"""The queries of this subpackage, by name, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tavola.llm import alignment, bpe, decontaminate, extraction, jaccard, licenses, linededup, prefix_trie, quality, sharding, token_files, toxicity, warc
from tavola.llm.tables import benchmark, conversations, documents, labels, pages


def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(pages(spark, folder))


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.fit_and_score(documents(spark, folder), labels(spark, folder))


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return linededup.digest(documents(spark, folder))


def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find(documents(spark, folder), benchmark(spark, folder))


def op5_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.round_trip(documents(spark, folder))


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.digest(documents(spark, folder))


def op7_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digest(documents(spark, folder))


def op8_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return extraction.extract_pages(pages(spark, folder))


def op9_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.digest(documents(spark, folder))


def op10_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(documents(spark, folder))


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.digest(conversations(spark, folder))


def op12_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(documents(spark, folder))


def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align_documents(documents(spark, folder))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_warc": op1_warc,
        "op2_toxicity": op2_toxicity,
        "op3_line_dedup": op3_line_dedup,
        "op4_decontamination": op4_decontamination,
        "op5_token_files": op5_token_files,
        "op6_quality_rules": op6_quality_rules,
        "op7_bpe": op7_bpe,
        "op8_extraction": op8_extraction,
        "op9_jaccard_join": op9_jaccard_join,
        "op10_sharding": op10_sharding,
        "op11_prefix_trie": op11_prefix_trie,
        "op12_licenses": op12_licenses,
        "op13_alignment": op13_alignment,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_warc": warc.SQL,
        "op6_quality_rules": quality.SQL,
        "op9_jaccard_join": jaccard.SQL,
        "op11_prefix_trie": prefix_trie.SQL,
    }
