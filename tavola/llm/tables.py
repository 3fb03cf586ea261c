"""Reading the tables, and how a row is known when ids repeat or are missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def pages(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/pages.parquet")


def benchmark(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/benchmark.parquet")


def labels(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/labels.parquet")


def conversations(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/conversations.parquet")


def text_key(column: str = "text") -> Column:
    """128 bits that stand for a text; a missing text has a key of its own."""
    text = F.col(column)
    return F.when(text.isNull(), F.lit("")).otherwise(F.md5(text.cast("binary")))


def same_row(left: DataFrame, right: DataFrame, names: list[str]):
    """The null-safe equality of ``names`` on both sides."""
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition
