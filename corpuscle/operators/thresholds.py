"""What a similarity threshold does to a set of queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuscle.functions.vectors import dot
from corpuscle.operators.cache import lookup

# The thresholds of the standard sweep, and the printed precision.
THRESHOLDS = (0.70, 0.75, 0.80, 0.85, 0.90, 0.95)
SHOWN_DIGITS = 3


def similarity_to(base: DataFrame, queries: DataFrame, digits: int = SHOWN_DIGITS) -> DataFrame:
    """Add ``similarity`` of every query to the one base query.

    The base is one vector; it becomes a constant of the projection, so there
    is no join. Other columns, such as a case label, are kept.
    """
    rows = base.select("vector").take(2)
    if len(rows) != 1:
        raise ValueError("the base must be exactly one query")
    constant = F.array(*[F.lit(float(x)) for x in rows[0]["vector"]])
    return queries.withColumn("similarity", F.round(dot(F.col("vector"), constant), digits))


def threshold_sweep(
    entries: DataFrame, queries: DataFrame, thresholds: Sequence[float] = THRESHOLDS
) -> DataFrame:
    """HIT or MISS of every query at every threshold against a fixed cache.

    The best match does not depend on the threshold, so the queries are looked
    up once. The bucket rule applies: an entry of another cluster is not seen.
    """
    best = lookup(entries, queries).drop("threshold", "cache_hit")
    steps = F.explode(F.array(*[F.lit(float(t)) for t in thresholds])).alias("threshold")
    return best.select("*", steps).withColumn(
        "outcome",
        F.when(F.col("score") >= F.col("threshold"), F.lit("HIT")).otherwise(F.lit("MISS")),
    )
