"""Bounded samples of labelled documents, for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(key: str = "doc_id", folds: int = 5) -> Column:
    """Rows that no model may learn from: crc32 of the key as text is divisible by ``folds``."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % folds == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: Column, rows: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text, label``: at most ``rows`` rows, one for each labelled key that is not held out.

    Which ones is settled by a hash of the key. Rows without key or label are
    left out; of several labels of a key the largest counts, and of several
    texts the smallest.
    """
    chosen = (
        labels.select(F.col(key).cast("bigint").alias("doc_id"), label.cast("int").alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull())
        .filter(~held_out())
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    texts = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    found = texts.join(F.broadcast(chosen), "doc_id")  # at most ``rows`` pairs of numbers
    return found.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label"))
