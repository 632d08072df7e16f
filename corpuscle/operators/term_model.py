"""Unit vectors of weighted terms; the weights are fitted once and stored with a collection.

Words fall into buckets by their MD5, so any engine gives the same buckets. How
many documents hold a bucket is counted once, on the corpus; documents and
queries are then weighted alike, whatever table they come in.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from corpuscle.functions.vectors import list_column
from corpuscle.operators.encode import DIMENSIONS

_WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class TermModel:
    """Documents that were counted, and how many of them hold each bucket."""

    documents: int
    frequencies: np.ndarray

    @property
    def weights(self) -> np.ndarray:
        """Inverse document frequencies, ``ln((n + 1) / (n with the bucket + 1))``."""
        return np.log((self.documents + 1.0) / (self.frequencies + 1.0))


def buckets(text: Column, dimensions: int = DIMENSIONS) -> Column:
    """The bucket of every word of a text, in order; none for a null text."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(_WORD), F.lit(0))
    hashed = lambda w: F.conv(F.substring(F.md5(w.cast("binary")), 1, 8), 16, 10).cast("bigint")
    return F.transform(words, lambda w: (hashed(w) % dimensions).cast("int"))


def fit(documents: DataFrame, text: str = "text", dimensions: int = DIMENSIONS) -> TermModel:
    """Count the buckets of all documents in one pass; a row per bucket reaches the driver."""
    held = documents.select(F.array_distinct(buckets(F.col(text), dimensions)).alias("held"))
    # An empty text counts as a document, too: it gives a row without bucket.
    rows = held.select(F.explode(F.concat(F.array(F.lit(-1)), "held")).alias("bucket")).groupBy("bucket").count().collect()
    counts = {r["bucket"]: r["count"] for r in rows}
    return TermModel(counts.pop(-1, 0), np.array([counts.get(i, 0) for i in range(dimensions)], dtype=np.int64))


def save(spark: SparkSession, model: TermModel, path: str) -> None:
    rows = [(i, int(n), model.documents) for i, n in enumerate(model.frequencies)]
    spark.createDataFrame(rows, "bucket int, frequency bigint, documents bigint").coalesce(1).write.mode("overwrite").parquet(path)


def load(spark: SparkSession, path: str) -> TermModel:
    rows = spark.read.parquet(path).orderBy("bucket").collect()  # a row per bucket
    return TermModel(rows[0]["documents"], np.array([r["frequency"] for r in rows], dtype=np.int64))


def embed(texts: DataFrame, model: TermModel, text: str = "text") -> DataFrame:
    """Add ``embedding``: weighted counts of unit length, zeros for a text without weighted words.

    A narrow step: words are hashed in the JVM, counted and scaled a batch at a time.
    """
    weights = model.weights

    @arrow_udf("array<double>")
    def scaled(found: pa.Array) -> pa.Array:
        lengths = found.value_lengths().to_numpy(zero_copy_only=False)
        if not len(lengths):
            return pa.array([], type=pa.list_(pa.float64()))
        cells = np.repeat(np.arange(len(lengths)), lengths) * len(weights) + found.flatten().to_numpy(zero_copy_only=False)
        counts = np.bincount(cells, minlength=len(lengths) * len(weights)).reshape(len(lengths), -1) * weights
        norms = np.linalg.norm(counts, axis=1, keepdims=True)
        return list_column(counts / np.where(norms > 0, norms, 1.0))

    return texts.withColumn("embedding", scaled(buckets(F.col(text), len(weights))))
