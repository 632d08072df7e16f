"""Checks on incoming requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuscle.operators.search import DEFAULT_RESULTS, MAX_RESULTS


def _reason() -> Column:
    query, threshold, n = F.col("query"), F.col("threshold"), F.col("n_results")
    return (
        F.when(query.isNull() | (query == ""), "query: at least 1 character")
        .when((threshold < 0.0) | (threshold > 1.0), "threshold: between 0 and 1")
        .when((n < 1) | (n > MAX_RESULTS), f"n_results: between 1 and {MAX_RESULTS}")
    )


def check_requests(requests: DataFrame) -> DataFrame:
    """Fill the default ``n_results`` and add ``reason``, null for a valid request."""
    filled = requests.withColumn(
        "n_results", F.coalesce(F.col("n_results"), F.lit(DEFAULT_RESULTS)).cast("int")
    )
    return filled.withColumn("reason", _reason())


def split_requests(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid requests, and rejected ones with the reason."""
    checked = check_requests(requests)
    valid = checked.filter(F.col("reason").isNull()).drop("reason")
    return valid, checked.filter(F.col("reason").isNotNull())
