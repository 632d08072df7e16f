"""Cosine silhouette in linear time, for several labelings at once.

For unit vectors the mean cosine distance of a point to a cluster is one minus
its inner product with the cluster's mean vector, so two passes over the
points replace all pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from corpuscle.functions.membership import MAX_CENTRE_BYTES
from corpuscle.functions.vectors import l2_normalize, matrix, sum_vector
from corpuscle.sources.shared import materialise

# Fixed value: score of a labeling that has no silhouette.
NO_SCORE = -1.0


def _point_scores(clusters: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]):
    @arrow_udf("double")
    def score(k: pa.Array, label: pa.Array, vector: pa.Array) -> pa.Array:
        ks = k.to_numpy(zero_copy_only=False)
        labels = label.to_numpy(zero_copy_only=False)
        x = matrix(vector)
        out = np.zeros(len(ks))
        for one_k in np.unique(ks):
            names, sums, counts = clusters[one_k]
            if len(names) < 2:
                continue
            rows = np.flatnonzero(ks == one_k)
            own = np.searchsorted(names, labels[rows])
            inner = x[rows] @ sums.T
            mean_distance = 1.0 - inner / counts
            at = np.arange(len(rows))
            size = counts[own]
            # The point itself is not among its neighbours.
            own_square = (x[rows] ** 2).sum(axis=1)
            inside = 1.0 - (inner[at, own] - own_square) / np.maximum(size - 1, 1)
            mean_distance[at, own] = np.inf
            outside = mean_distance.min(axis=1)
            larger = np.maximum(inside, outside)
            value = np.where(larger > 0, (outside - inside) / np.where(larger > 0, larger, 1.0), 0.0)
            out[rows] = np.where(size > 1, value, 0.0)
        return pa.array(out)

    return score


def silhouettes(labelled: DataFrame) -> DataFrame:
    """Rows ``k, silhouette`` from rows ``k, label, embedding``.

    A labeling with fewer than two clusters, or as many clusters as points,
    scores -1.
    """
    unit = labelled.select("k", "label", l2_normalize(F.col("embedding")).alias("embedding"))
    # One row per cluster: written once, and checked before it comes to the driver.
    sums = materialise(
        unit.groupBy("k", "label").agg(
            sum_vector(F.col("embedding")).alias("total"), F.count("*").alias("n")
        ),
        "cluster-sums",
    )
    size = sums.agg(F.sum(F.size("total")).alias("cells")).first()["cells"] or 0
    if size * 8 > MAX_CENTRE_BYTES:
        raise ValueError("too many clusters to hold their sums in one task")
    clusters: dict[int, tuple] = {}
    table = sums.orderBy("k", "label").toPandas()
    for k, rows in table.groupby("k"):
        clusters[k] = (
            rows["label"].to_numpy(),
            np.stack(rows["total"].to_numpy()),
            rows["n"].to_numpy(dtype=np.float64),
        )
    score = _point_scores(clusters)
    usable = F.count_distinct("label")
    scored = unit.withColumn("score", score("k", "label", "embedding"))
    return scored.groupBy("k").agg(
        F.when((usable < 2) | (usable >= F.count("*")), F.lit(NO_SCORE))
        .otherwise(F.avg("score"))
        .alias("silhouette")
    )
