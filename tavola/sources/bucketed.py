"""Two tables stored in buckets of a key, so that joining them on it moves no row.

Lines and their orders are joined by many runs and change rarely. Stored in the same number
of buckets of the order id and sorted in them, they meet without a shuffle. A bucket can not
be split, so keys that hold a large share of the lines are kept apart: there are only a few
such keys by the definition of large, and their orders are sent to their lines instead.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A key is large if it holds more than this part of an average bucket, so there are at most
#: ``buckets / SHARE`` large keys, whatever the data.
SHARE = 0.25


class BucketedPair:
    """``facts`` and ``details`` (one or few rows a key) under ``folder``, bucketed by ``key``."""

    def __init__(self, spark: SparkSession, folder: str, key: str, buckets: int) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self.key, self.buckets = key, buckets

    def _path(self, part: str) -> str:
        return f"{self.folder}/{part}"

    def _table(self, part: str) -> str:
        # the session's catalog knows the buckets; the files say nothing of them
        told = f"{self._path(part)} {self.key} {self.buckets}"
        return f"tavola_{part}_{hashlib.md5(told.encode()).hexdigest()[:16]}"

    def _store(self, df: DataFrame, part: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self._table(part)}")
        (
            df.repartition(self.buckets, self.key)
            .write.mode("overwrite")
            .format("parquet")
            .option("path", self._path(part))
            .bucketBy(self.buckets, self.key)
            .sortBy(self.key)
            .saveAsTable(self._table(part))
        )

    def _read(self, part: str) -> DataFrame:
        """The stored table with its buckets, also in a session that did not store it."""
        name = self._table(part)
        if not self.spark.catalog.tableExists(name):
            schema = self.spark.read.parquet(self._path(part)).schema
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}) USING parquet "
                f"CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) INTO {self.buckets} BUCKETS "
                f"LOCATION '{self._path(part)}'"
            )
        return self.spark.table(name)

    def store(self, facts: DataFrame, details: DataFrame) -> None:
        """Write both tables. Rows without a key are left out: they join with nothing."""
        facts = facts.filter(F.col(self.key).isNotNull())
        details = details.filter(F.col(self.key).isNotNull())
        counts = facts.groupBy(self.key).agg(F.count("*").alias("rows"))
        least = facts.agg(F.floor(F.count("*") * SHARE / self.buckets) + 1).first()[0]
        counts.filter(F.col("rows") > least).select(self.key).write.mode("overwrite").parquet(
            self._path("large_keys")
        )
        large = F.broadcast(self.large_keys())
        self._store(facts.join(large, self.key, "left_anti"), "facts")
        facts.join(large, self.key, "left_semi").write.mode("overwrite").parquet(self._path("large_facts"))
        self._store(details, "details")

    def large_keys(self) -> DataFrame:
        return self.spark.read.parquet(self._path("large_keys"))

    def joined(self, fact_columns: list[str], detail_columns: list[str]) -> DataFrame:
        """Facts with their details; the columns of each side besides the key are given."""
        details = self._read("details").select(self.key, *detail_columns)
        small = self._read("facts").select(self.key, *fact_columns).join(details, self.key)
        few = F.broadcast(details.join(F.broadcast(self.large_keys()), self.key, "left_semi"))
        large = self.spark.read.parquet(self._path("large_facts")).select(self.key, *fact_columns)
        return small.unionByName(large.join(few, self.key))
