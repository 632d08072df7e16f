"""The semantic cache as tables: assignment, lookup, entries and statistics."""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuscle.functions import membership as mb
from corpuscle.operators.matching import TRAVEL_ROWS, match_in_place, top_matches
from corpuscle.operators.search import SIMILARITY_DIGITS

# Fixed values.
DEFAULT_THRESHOLD = 0.80
RATE_DIGITS = 4

HIT_TYPE = "array<struct<id:int,category:string,similarity:double,text:string>>"
ENTRY_SCHEMA = (
    f"seq bigint, query string, vector array<float>, result {HIT_TYPE}, "
    "dominant_cluster int, membership_vector array<double>"
)


@dataclass(frozen=True)
class CacheState:
    """Cache entries (one row each, ``seq`` in insert order) and counters."""

    entries: DataFrame
    hit_count: int = 0
    miss_count: int = 0
    threshold: float = DEFAULT_THRESHOLD

    def record(self, hits: int = 0, misses: int = 0) -> CacheState:
        return replace(
            self, hit_count=self.hit_count + hits, miss_count=self.miss_count + misses
        )

    def flush(self) -> CacheState:
        """No entries, counters at zero; the threshold stays."""
        return replace(self, entries=self.entries.limit(0), hit_count=0, miss_count=0)

    def stats(self) -> DataFrame:
        counted = self.entries.agg(F.count_distinct("query").alias("total_entries"))
        return with_rate(
            counted.select(
                "total_entries",
                F.lit(self.hit_count).cast("bigint").alias("hit_count"),
                F.lit(self.miss_count).cast("bigint").alias("miss_count"),
            ),
            self.threshold,
        )


def empty_cache(spark: SparkSession, threshold: float = DEFAULT_THRESHOLD) -> CacheState:
    return CacheState(spark.createDataFrame([], ENTRY_SCHEMA), threshold=threshold)


def with_rate(counted: DataFrame, threshold: float) -> DataFrame:
    """Add ``hit_rate`` (0 before the first request) and ``threshold``."""
    total = F.col("hit_count") + F.col("miss_count")
    return counted.select(
        "total_entries",
        "hit_count",
        "miss_count",
        F.when(total > 0, F.round(F.col("hit_count") / total, RATE_DIGITS))
        .otherwise(F.lit(0.0))
        .alias("hit_rate"),
        F.lit(float(threshold)).alias("threshold"),
    )


def assign_clusters(
    rows: DataFrame,
    centres: np.ndarray,
    vector: str = "vector",
    fuzziness: float = mb.FUZZINESS,
) -> DataFrame:
    """Add ``membership_vector`` and ``dominant_cluster``: narrow, no shuffle."""
    assign = mb.memberships(centres, fuzziness)
    return rows.withColumn("membership_vector", assign(vector)).withColumn(
        "dominant_cluster", mb.hard_label(F.col("membership_vector"))
    )


def lookup(
    entries: DataFrame,
    queries: DataFrame,
    threshold: float = DEFAULT_THRESHOLD,
    **limits: int,
) -> DataFrame:
    """Look every query up in a fixed cache; all columns of ``queries`` are kept.

    Only entries of the query's dominant cluster are compared. A cache small
    enough to travel is matched in place, without a shuffle. Adds
    ``entry_seq`` and ``score`` of the best one (the earliest on ties; null if
    the bucket is empty) and ``cache_hit``. A ``threshold`` column, where not
    null, overrides the default for its row.
    """
    in_place = match_in_place(
        entries,
        entry_id="seq",
        bucket="dominant_cluster",
        travel_rows=limits.get("travel_rows", TRAVEL_ROWS),
    )
    if in_place is not None:
        match = in_place(F.col("dominant_cluster").cast("bigint"), F.col("vector"))
        found = queries.withColumn("_match", match).select(
            *queries.columns,
            F.col("_match.entry").alias("entry_seq"),
            F.col("_match.score").alias("score"),
        )
    else:
        best = top_matches(
            entries,
            queries,
            1,
            entry_id="seq",
            query_id="seq",
            entry_vector="vector",
            query_vector="vector",
            bucket="dominant_cluster",
            **limits,
        ).select(F.col("query").alias("seq"), F.col("entry").alias("entry_seq"), "score")
        found = queries.join(best, "seq", "left")
    limit = F.lit(float(threshold))
    if "threshold" in queries.columns:
        limit = F.coalesce(F.col("threshold"), limit)
    return found.withColumn("cache_hit", F.coalesce(F.col("score") >= limit, F.lit(False)))


def lookup_answers(found: DataFrame, entries: DataFrame) -> DataFrame:
    """Hits of a lookup with the cached query and result; ``score`` becomes ``similarity_score``."""
    cached = entries.select(
        F.col("seq").alias("entry_seq"), F.col("query").alias("matched_query"), "result"
    )
    return (
        found.filter("cache_hit")
        .join(cached, "entry_seq")
        .withColumn("similarity_score", F.round("score", SIMILARITY_DIGITS))
        .drop("score", "entry_seq")
    )


def count_outcomes(decisions: DataFrame) -> DataFrame:
    """One row: ``hit_count, miss_count``."""
    return decisions.agg(
        F.count_if(F.col("cache_hit")).alias("hit_count"),
        F.count_if(~F.col("cache_hit")).alias("miss_count"),
    )


def health(documents: DataFrame, centres: DataFrame, entries: DataFrame) -> DataFrame:
    """One row: indexed documents, clusters, cached queries."""

    def number(rows: DataFrame, value: Column, name: str) -> Column:
        return rows.agg(value).scalar().alias(name)

    return documents.sparkSession.range(1).select(
        F.lit("healthy").alias("status"),
        number(documents, F.count("*"), "indexed_documents"),
        number(centres, F.count("*"), "n_clusters"),
        number(entries, F.count_distinct("query"), "cached_queries"),
    )
