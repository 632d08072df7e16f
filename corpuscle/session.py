"""Spark session settings the jobs are written for."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Runtime re-planning does the partition sizing: start with many shuffle
# partitions and let AQE coalesce them, split skewed ones and swap joins.
_CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "corpuscle", master: str | None = None, **conf: str) -> SparkSession:
    """Get a session; ``conf`` keys use ``__`` for dots (``spark__driver__memory``)."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in _CLUSTER_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    ship_package(spark)
    bound_batches(spark)
    drop_shuffles(spark)
    return spark


# Bytes of rows that Python workers get at a time, unless the session states its own bound.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES_DEFAULT = "4m"


def bound_batches(spark: SparkSession) -> None:
    """Bound a worker's batches by bytes: ten thousand long vectors are too many for one."""
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, BATCH_BYTES_DEFAULT)


# Shuffle files go when the job that wrote them ends, unless the session states otherwise: a query of
# many jobs would else keep them all until the driver happens to collect its garbage.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def drop_shuffles(spark: SparkSession) -> None:
    """Let each job remove its shuffle files at its end; what later jobs read is written as tables."""
    if spark.conf.get(DROP_SHUFFLES, None) is None:
        spark.conf.set(DROP_SHUFFLES, "true")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = Path(__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="corpuscle-pkg-")) / "corpuscle.zip"
    with zipfile.ZipFile(archive, "w") as target:
        for module in sorted(package.rglob("*.py")):
            target.write(module, module.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(app)
