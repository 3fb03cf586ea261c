"""The folder that the driver and all executors share, and tables written there."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session.

    Only a local master may go without: its driver is its executor, so a folder of the
    machine will do until the process ends.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="tavola-shared-"))
        atexit.register(shutil.rmtree, _own[0], ignore_errors=True)
    return f"file://{_own[0]}"


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nobody else uses."""
    return f"{shared_folder(spark)}/tavola-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Cuts the lineage and fixes values that a second run could give otherwise; the files
    outlive executors.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
