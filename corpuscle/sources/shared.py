"""Intermediate tables that cut lineage and survive the loss of executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest table of ids and numbers that a join copies to every executor.
SMALL_ROWS = 500_000

_LOCAL_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. A local session without
    the setting gets a temporary folder; a cluster without it is an error,
    because a folder on one machine would be lost with that machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    app = context.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="corpuscle-")
    return _LOCAL_DIRS[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other table uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Delete what was written at a ``fresh_path`` that no DataFrame will read again."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialise(
    df: DataFrame, name: str, partition_by: list[str] | None = None, compression: str | None = None
) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and return a scan of it.

    Unlike ``checkpoint()`` this computes the plan once, and later readers
    prune columns and partitions. ``compression`` is the session's unless named:
    for texts 'zstd' takes a third less disk.
    """
    path = fresh_path(df.sparkSession, name)
    writer = df.write.option("compression", compression) if compression else df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Spread rows by ``key`` if the input has fewer splits than there are cores.

    For costly work on texts that come as one unsplittable file. An input with
    enough splits, as any large table has, is left as it is: no shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def small_side(df: DataFrame, name: str, rows: int = SMALL_ROWS) -> DataFrame:
    """Write ``df`` once; up to ``rows`` rows, mark the scan of it for broadcast.

    So a large other side is neither shuffled nor read twice. Above the limit
    the join is left to the optimizer. For narrow rows: ids and numbers.
    """
    table = materialise(df, name)
    return F.broadcast(table) if table.count() <= rows else table
