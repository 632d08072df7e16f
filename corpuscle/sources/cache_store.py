"""Snapshots of the semantic cache: a table of entries and a one-row table of counters."""

from __future__ import annotations

import logging

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from corpuscle.operators.cache import DEFAULT_THRESHOLD, ENTRY_SCHEMA, CacheState, empty_cache
from corpuscle.sources.shared import materialise

_COUNTERS = "threshold double, hit_count bigint, miss_count bigint"
# What errors say of a folder that isn't there, and of files that are no tables.
_ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")
_DAMAGED = ("is not a Parquet file", "CANNOT_READ_FILE_FOOTER", "corrupted")
_ERRORS = (PySparkException, Py4JJavaError)

log = logging.getLogger(__name__)


def _write_counters(spark: SparkSession, path: str, row: tuple) -> None:
    spark.createDataFrame([row], _COUNTERS).coalesce(1).write.mode("overwrite").parquet(f"{path}/counters")


def _counters(spark: SparkSession, path: str):
    return spark.read.schema(_COUNTERS).parquet(f"{path}/counters").first()


def _says(error: Exception, signs: tuple[str, ...]) -> bool:
    text = str(error)
    return any(sign in text for sign in signs)


def save_snapshot(spark: SparkSession, state: CacheState, path: str) -> None:
    """Save entries, counters and threshold in place of an older snapshot."""
    # Written elsewhere first: the entries may come from the snapshot they replace.
    entries = materialise(state.entries, "cache-entries")
    entries.write.mode("overwrite").parquet(f"{path}/entries")
    _write_counters(spark, path, (float(state.threshold), state.hit_count, state.miss_count))


def save_counters(spark: SparkSession, state: CacheState, path: str) -> None:
    """Save the counters only; a full snapshot if there is none to add to."""
    try:
        saved = _counters(spark, path)
    except _ERRORS as error:
        if not _says(error, _ABSENT):
            raise
        saved = None
    if saved is None:
        save_snapshot(spark, state, path)
    else:
        _write_counters(spark, path, (saved["threshold"], state.hit_count, state.miss_count))


def load_snapshot(spark: SparkSession, path: str, threshold: float = DEFAULT_THRESHOLD) -> CacheState:
    """The saved cache; its threshold wins over the argument.

    An absent snapshot, or one whose files are damaged, gives an empty cache.
    Other failures, such as a lost executor or a storage that doesn't answer, raise.
    """
    try:
        saved = _counters(spark, path)
        entries = spark.read.schema(ENTRY_SCHEMA).parquet(f"{path}/entries")
        entries.agg(F.count("query")).first()  # fails here if the files are damaged
    except _ERRORS as error:
        if _says(error, _DAMAGED):
            log.warning("cache snapshot at %s is damaged, starting empty", path)
        elif not _says(error, _ABSENT):
            raise
        return empty_cache(spark, threshold)
    if saved is None:
        return empty_cache(spark, threshold)
    return CacheState(entries, saved["hit_count"], saved["miss_count"], saved["threshold"])
