"""Session helpers: durable checkpoints and scan parallelism."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Rows of a dimension that may be broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 200_000
# Splits of a table that may be dealt out anew.
FEW_SPLITS = 8

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hand the package to the Python workers, wherever the driver was started."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="foliant-package-"), "foliant")
    context.addPyFile(shutil.make_archive(target, "zip", root, "foliant"))
    _shipped.add(context.applicationId)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; a
    cluster must name a shared one, or lost executors would lose the data.
    """
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all nodes share")
        folder = tempfile.mkdtemp(prefix="foliant-checkpoint-")
    context.setCheckpointDir(folder)


def scratch_folder(spark: SparkSession) -> str:
    """A new folder next to the checkpoints, visible to every executor."""
    ensure_checkpoint_dir(spark)
    base = spark.sparkContext.getCheckpointDir().rstrip("/")
    return f"{base}/scratch-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage through reliable storage; survives losing executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write to a scratch path and read back.

    A loop needs this rather than :func:`durable`: a checkpoint keeps the size its plan was
    estimated at, and each join multiplies the sizes of its sides, so that the numbers
    themselves fill the driver after some dozens of rounds.
    """
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch path whose table is no longer read."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-spread a scan of a few splits, which may all but one be empty.

    A table written as one row group would otherwise run its per-row work on a
    single core. Fewer than ``FEW_SPLITS`` splits hold at most that many times
    ``spark.sql.files.maxPartitionBytes``, so no larger table is ever shuffled,
    however many cores there are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= min(cores, FEW_SPLITS):
        return df
    return df.repartition(cores, key)
