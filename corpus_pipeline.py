"""From documents to packed sequences: filters, near duplicates, decontamination, packing.

Each stage works on what its predecessor kept and returns the columns of
``documents``; the last one returns the packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpuscle.llm import decontaminate, jaccard, ordinal, packing, toxicity
from corpuscle.llm.queries import GRADES, grade
from corpuscle.sources.shared import materialise

# Bytes of text that Python workers get at a time, unless the session states its own bound.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES_DEFAULT = "4m"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def in_small_batches(stage: Stage) -> Stage:
    """``stage`` in a session whose batches are bounded by bytes, as its result is computed later."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if spark.conf.get(BATCH_BYTES, None) is None:
            spark.conf.set(BATCH_BYTES, BATCH_BYTES_DEFAULT)
        return stage(spark, docs, sf_dir)

    return run_stage


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model predicts clean."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(docs, toxicity.fit(docs, labels))


def reject_bad(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose grade is more likely than not above the lowest."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return ordinal.keep_good(docs, ordinal.fit(docs, labels, grade(), GRADES))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates."""
    return jaccard.keep_one(docs)


def reject_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item stands."""
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), short_within=True)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", in_small_batches(reject_toxic)),
    ("quality classifier", in_small_batches(reject_bad)),
    ("n-gram Jaccard join", in_small_batches(keep_one_of_each)),
    ("benchmark decontamination", in_small_batches(reject_contaminated)),
    ("best-fit packing", in_small_batches(pack)),
]

# Classifiers, similarity groups and a tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
