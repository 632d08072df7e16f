"""Running totals along a global order, without a one-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuscle.sources.shared import materialise


def with_running_totals(rows: DataFrame, order: str | list[str], amounts: dict[str, Column]) -> DataFrame:
    """Add, per name, the sum of its amount over this row and all rows before it.

    ``order`` names columns that are unique together. Rows are dealt into ranges
    that Spark samples from the data, so gaps in the order don't matter, and
    written once with their range. Totals are taken inside ranges; what comes
    before a range is added from a table with one row per range.
    """
    keys = [order] if isinstance(order, str) else list(order)
    ranged = rows.repartitionByRange(*keys).withColumn("_range", F.spark_partition_id())
    ranged = materialise(ranged, "ranges")
    per_range = ranged.groupBy("_range").agg(*[F.sum(amount).alias(name) for name, amount in amounts.items()])
    earlier = Window.orderBy("_range")
    before = per_range.select(
        "_range", *[(F.sum(name).over(earlier) - F.col(name)).alias(f"_before_{name}") for name in amounts]
    )
    inside = Window.partitionBy("_range").orderBy(*keys).rowsBetween(Window.unboundedPreceding, 0)
    totals = [F.sum(amount).over(inside).alias(f"_inside_{name}") for name, amount in amounts.items()]
    # One row per partition of a shuffle.
    joined = ranged.select("*", *totals).join(F.broadcast(before), "_range")
    return joined.select(
        *rows.columns, *[(F.col(f"_before_{n}") + F.col(f"_inside_{n}")).alias(n) for n in amounts]
    )


def with_dense_index(rows: DataFrame, order: str | list[str], name: str) -> DataFrame:
    """Number rows 0, 1, 2, ... along columns that are unique together."""
    counted = with_running_totals(rows, order, {name: F.lit(1).cast("bigint")})
    return counted.withColumn(name, F.col(name) - 1)
