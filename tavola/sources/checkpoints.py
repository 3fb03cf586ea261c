"""Reliable materialisation of inputs that are read many times."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def use_checkpoint_dir(spark: SparkSession) -> None:
    """Point checkpoints at the shared folder named by the session.

    Only a local master may fall back to a folder of its own.
    """
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="tavola-checkpoints-")
        atexit.register(shutil.rmtree, shared, ignore_errors=True)
    context.setCheckpointDir(shared)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder once and read it from there.

    The files outlive lost executors, and every later pass sees the same rows.
    """
    use_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def laid_out(df: DataFrame, key: str, rows_per_part: int = 100_000) -> DataFrame:
    """``df`` materialised in parts by a hash of ``key``, in order inside them.

    Model fits draw per part. The number of parts follows from the number of rows, 8 at
    least, so fits are as parallel as the data is large, and repeatable whatever the
    session's number of shuffle partitions.
    """
    rows = materialize(df)
    parts = max(8, -(-rows.count() // rows_per_part))
    return materialize(rows.repartition(parts, key).sortWithinPartitions(key))
