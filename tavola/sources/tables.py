"""Read and write the tables of the model and the results of the operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.ml.util import MLWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from tavola.operators.periods import orders_with_month
from tavola.sources.schemas import CORRUPT, schema_of


def _is_missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def read_table(spark: SparkSession, name: str, path: str, fmt: str = "csv") -> DataFrame | None:
    """A source table, or None when its path does not exist.

    CSV rows that do not fit the schema keep their readable fields, get null for
    the others and carry the raw text in ``_corrupt_record``. Stored tables keep
    that column for :func:`read_rejects`; it is not part of the table read here.
    """
    try:
        if fmt == "csv":
            return (
                spark.read.schema(schema_of(name, with_corrupt=True))
                .option("header", True)
                .option("mode", "PERMISSIVE")
                .csv(path)
            )
        return spark.read.format(fmt).load(_readable(spark, path)).drop(CORRUPT)
    except AnalysisException as error:
        if _is_missing(error):
            return None
        raise


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a stored table whose text did not fit its schema."""
    return spark.read.parquet(path).filter(F.col(CORRUPT).isNotNull())


def read_with_fallback(
    spark: SparkSession, candidates: Iterable[tuple[str, str, str]]
) -> DataFrame | None:
    """The first ``(name, path, format)`` that exists; only a missing path is skipped."""
    for name, path, fmt in candidates:
        found = read_table(spark, name, path, fmt)
        if found is not None:
            return found
    return None


def read_restaurants(spark: SparkSession, parquet_path: str, csv_path: str) -> DataFrame | None:
    """Restaurants from Parquet; if there is none yet, from CSV, which is then stored."""
    stored = read_table(spark, "restaurants", parquet_path, "parquet")
    if stored is not None:
        return stored
    raw = read_table(spark, "restaurants", csv_path, "csv")
    if raw is None:
        return None
    write_table(raw, parquet_path)
    return read_table(spark, "restaurants", parquet_path, "parquet")


def read_wastage_share(spark: SparkSession, analysis: str, risk: str) -> DataFrame | None:
    """``(item_id, wastage_pct)`` from the wastage analysis, else from the risk table."""
    found = read_table(spark, "wastage_analysis", analysis, "parquet")
    if found is not None:
        return found.select("item_id", "wastage_pct")
    found = read_table(spark, "wastage_risk", risk, "parquet")
    if found is not None:
        return found.select("item_id", F.col("waste_ratio").alias("wastage_pct"))
    return None


def _file_system(spark: SparkSession, path: str):
    """Hadoop's file system of ``path``, and a function that makes paths for it."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


def _old(path: str) -> str:
    return f"{path.rstrip('/')}.old"


def _readable(spark: SparkSession, path: str) -> str:
    """``path``, or its last version if a writer stopped between taking it away and switching."""
    files, make = _file_system(spark, path)
    if not files.exists(make(path)) and files.exists(make(_old(path))):
        return _old(path)
    return path


def write_table(df: DataFrame, path: str, partition_by: Iterable[str] = ()) -> None:
    """Write a table in place of the one at ``path``, which stays readable until it is done.

    Files go to a folder beside it; when all of them are there, the folders change places by
    renaming. A run that fails, or reads the table that it writes, leaves the old one as it
    was. In a store that renames by copying, the switch takes as long as a copy; a reader that
    meets it half done takes the last version (:func:`read_table`).
    """
    spark, path = df.sparkSession, path.rstrip("/")
    files, make = _file_system(spark, path)
    staged = f"{path}.new-{uuid.uuid4().hex}"
    try:
        df.write.partitionBy(*partition_by).parquet(staged)
    except BaseException:
        files.delete(make(staged), True)
        raise
    if files.exists(make(path)):
        files.delete(make(_old(path)), True)
        _rename(files, make(path), make(_old(path)))
    _rename(files, make(staged), make(path))
    files.delete(make(_old(path)), True)


def _rename(files, source, target) -> None:
    if not files.rename(source, target):
        raise OSError(f"cannot rename {source} to {target}")


def _by_month(orders: DataFrame) -> DataFrame:
    """Paid orders with their month, rebalanced by it, so that a task writes few files and a
    month that holds most of the rows is split between tasks."""
    return orders_with_month(orders).hint("rebalance", F.col("month"))


def write_partitioned_orders(orders: DataFrame, path: str) -> None:
    """Paid orders, one folder per month (years merged)."""
    write_table(_by_month(orders), path, ["month"])


def replace_months(orders: DataFrame, path: str) -> None:
    """Rewrite the months that ``orders`` has, and leave the files of all others.

    Spark stages the files of every month and moves them when all tasks are done.
    """
    (
        _by_month(orders)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("month")
        .parquet(path)
    )


def export_csv_report(df: DataFrame, path: str) -> None:
    """A folder of CSV part files, written by the executors.

    Arrays become comma-separated text, which the CSV writer needs.
    """
    flat = [
        F.array_join(F.col(f.name).cast("array<string>"), ",").alias(f.name)
        if isinstance(f.dataType, ArrayType)
        else F.col(f.name)
        for f in df.schema
    ]
    df.select(*flat).write.mode("overwrite").option("header", True).csv(path)


def write_metrics(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def save_model(model: MLWritable, path: str) -> None:
    model.write().overwrite().save(path)
