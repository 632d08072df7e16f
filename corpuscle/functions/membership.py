"""Fuzzy membership of vectors in given centres, and measures of a membership."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from corpuscle.functions.vectors import list_column, matrix

# Results depend on them.
FUZZINESS = 2.0
ENTROPY_FLOOR = 1e-10

# Centres travel to every task with the function that uses them.
MAX_CENTRE_BYTES = 128 * 1024 * 1024


def collect_centres(centres: DataFrame) -> np.ndarray:
    """The centre table (``cluster``, ``centre``) as a matrix, in cluster order.

    Only a table of checked size is taken: k x dim doubles.
    """
    size = centres.agg(F.sum(F.size("centre")).alias("cells")).first()["cells"] or 0
    if size * 8 > MAX_CENTRE_BYTES:
        raise ValueError(f"centre table of {size} doubles is over {MAX_CENTRE_BYTES} bytes")
    rows = centres.select("cluster", "centre").orderBy("cluster").collect()
    if [row["cluster"] for row in rows] != list(range(len(rows))):
        raise ValueError("clusters must be numbered 0..k-1")
    return np.array([row["centre"] for row in rows], dtype=np.float64)


def distances(points: np.ndarray, centres: np.ndarray, squares: np.ndarray | None = None) -> np.ndarray:
    """Euclidean distances, points x centres, kept above zero; ``squares`` of the points' lengths if known."""
    if squares is None:
        squares = (points**2).sum(axis=1)
    squared = squares[:, None] + (centres**2).sum(axis=1)[None, :] - 2.0 * (points @ centres.T)
    # The expanded square cancels near zero; those cells are done directly.
    close_points, close_centres = np.nonzero(squared < 1e-6)
    for start in range(0, len(close_points), 4096):
        i, j = close_points[start : start + 4096], close_centres[start : start + 4096]
        squared[i, j] = ((points[i] - centres[j]) ** 2).sum(axis=1)
    return np.maximum(np.sqrt(np.maximum(squared, 0.0)), np.finfo(np.float64).eps)


def membership_matrix(dist: np.ndarray, fuzziness: float) -> np.ndarray:
    """Closed form of the membership for fixed centres; rows sum to 1."""
    # Scaled by the nearest centre first, so that no power overflows.
    relative = dist / dist.min(axis=1, keepdims=True)
    weight = relative ** (-2.0 / (fuzziness - 1.0))
    return weight / weight.sum(axis=1, keepdims=True)


def memberships(centres: np.ndarray, fuzziness: float = FUZZINESS) -> Callable[[Column | str], Column]:
    """Column function ``vector -> array<double>``: one membership per centre.

    Only the vector column goes to Python, as Arrow; other columns wait in the JVM.
    """

    @arrow_udf("array<double>")
    def assign(vector: pa.Array) -> pa.Array:
        if len(vector) == 0:
            return pa.array([], type=pa.list_(pa.float64()))
        return list_column(membership_matrix(distances(matrix(vector), centres), fuzziness))

    return assign


def hard_label(membership: Column) -> Column:
    """Cluster of the largest membership; the first one on ties."""
    return (F.array_position(membership, F.array_max(membership)) - 1).cast("int")


def entropy(membership: Column) -> Column:
    """Shannon entropy in nats, memberships clipped away from zero."""
    clipped = F.transform(
        membership, lambda u: F.greatest(F.least(u, F.lit(1.0)), F.lit(ENTROPY_FLOOR))
    )
    return -F.aggregate(clipped, F.lit(0.0), lambda acc, u: acc + u * F.ln(u))


def partition_coefficient(membership: Column) -> Column:
    """Aggregate: mean of the squared memberships; 1/k when all are equal."""
    return F.avg(F.aggregate(membership, F.lit(0.0), lambda acc, u: acc + u * u))


def largest_memberships(membership: Column, n: int) -> Column:
    """The ``n`` largest as ``array<struct<cluster, membership>>``, largest first."""
    pairs = F.transform(
        membership, lambda u, i: F.struct((-u).alias("order"), i.alias("cluster"))
    )
    return F.transform(
        F.slice(F.array_sort(pairs), 1, n),
        lambda p: F.struct(
            p["cluster"].cast("string").alias("cluster"), (-p["order"]).alias("membership")
        ),
    )
