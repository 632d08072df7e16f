"""Choice of the number of clusters and the final fit."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from corpuscle.functions.membership import FUZZINESS, distances, membership_matrix
from corpuscle.functions.vectors import l2_normalize, matrix
from corpuscle.operators import fcm
from corpuscle.operators.silhouette import NO_SCORE, silhouettes
from corpuscle.sources.shared import materialise


def select_k(scores: DataFrame, bounds: tuple[int, int] = fcm.CLUSTER_BOUNDS) -> DataFrame:
    """One row ``best_k, silhouette, selected_k`` from rows ``k, silhouette``.

    The highest score wins, the smallest k on ties; the winner is then moved
    into ``bounds``. The result is empty when no k has a score.
    """
    low, high = bounds
    best = F.max_by(F.struct("k", "silhouette"), F.struct("silhouette", -F.col("k")))
    return (
        scores.filter(F.col("silhouette") > NO_SCORE)
        .agg(best.alias("best"))
        .filter(F.col("best").isNotNull())
        .select(
            F.col("best.k").alias("best_k"),
            F.col("best.silhouette").alias("silhouette"),
            F.greatest(F.lit(low), F.least(F.lit(high), F.col("best.k"))).alias("selected_k"),
        )
    )


def hard_labels(points: DataFrame, fits: dict[int, fcm.FuzzyFit], fuzziness: float) -> DataFrame:
    """Rows ``k, label, embedding``: every point under every fit."""
    centre_sets = [(k, fit.centres) for k, fit in sorted(fits.items())]

    @arrow_udf("array<int>")
    def labels(vector: pa.Array) -> pa.Array:
        if len(vector) == 0:
            return pa.array([], type=pa.list_(pa.int32()))
        x = matrix(vector)
        columns = [
            np.argmax(membership_matrix(distances(x, centres), fuzziness), axis=1)
            for _, centres in centre_sets
        ]
        return pa.array(list(np.stack(columns, axis=1).astype(np.int32)), type=pa.list_(pa.int32()))

    ks = F.array(*[F.lit(k) for k, _ in centre_sets])
    labelled = points.withColumn("_labels", labels("embedding"))
    return labelled.select(
        F.explode(F.arrays_zip(ks.alias("k"), F.col("_labels").alias("label"))).alias("_kl"),
        "embedding",
    ).select("_kl.k", "_kl.label", "embedding")


@dataclass(frozen=True)
class Sweep:
    """Fits and scores of all candidate numbers of clusters."""

    points: DataFrame
    fits: dict[int, fcm.FuzzyFit]
    scores: DataFrame
    fuzziness: float


def fit_points(
    vectors: DataFrame,
    sample_size: int | None = None,
    key: str = "doc_id",
    seed: int = fcm.SEED,
    strata: str | None = None,
) -> DataFrame:
    """Unit vectors and start keys of all rows, or of a sample (by ``strata`` if given), written once."""
    rows = vectors.select(key, "embedding", *([strata] if strata else []))
    if sample_size is not None:
        # A sample is one partition after the limit; the passes use more.
        slices = min(rows.sparkSession.sparkContext.defaultParallelism, sample_size // 512)
        if strata:
            sample = fcm.stratified_rows(rows, strata, sample_size, key, seed)
        else:
            sample = fcm.sample_rows(rows, sample_size, key, seed)
        rows = sample.repartition(max(1, slices), key)
    points = rows.select(
        l2_normalize(F.col("embedding")).alias("embedding"),
        fcm.start_key(key, seed).alias("start_key"),
    )
    return materialise(points, "fcm-points")


def sweep_k(
    points: DataFrame,
    cluster_counts: Sequence[int] = fcm.CLUSTER_COUNTS,
    *,
    fuzziness: float = FUZZINESS,
    tolerance: float = fcm.TOLERANCE,
    max_passes: int = fcm.MAX_PASSES,
) -> Sweep:
    """Fit every k over shared passes and score the hard labels of each.

    ``scores``: ``k, silhouette, fpc, objective, passes, converged, collapsed``.
    """
    spark = points.sparkSession
    points = points.cache()
    fits = fcm.fit_fuzzy(
        points, cluster_counts, fuzziness=fuzziness, tolerance=tolerance, max_passes=max_passes
    )
    facts = spark.createDataFrame(
        [
            (f.k, f.fpc, f.objective, f.passes, f.converged, f.collapsed)
            for f in fits.values()
        ],
        "k int, fpc double, objective double, passes int, converged boolean, collapsed boolean",
    )
    scored = silhouettes(hard_labels(points, fits, fuzziness))
    scores = scored.join(F.broadcast(facts), "k").select(
        "k", "silhouette", "fpc", "objective", "passes", "converged", "collapsed"
    )
    return Sweep(points, fits, scores, fuzziness)


@dataclass(frozen=True)
class ChosenModel:
    k: int
    centres: np.ndarray
    collapsed: bool
    scores: DataFrame


def choose_model(
    sweep: Sweep, bounds: tuple[int, int] = fcm.CLUSTER_BOUNDS, **fit_options
) -> ChosenModel:
    """Pick k by silhouette and refit only if the bounds moved k to one not fitted."""
    scores = materialise(sweep.scores, "k-scores")
    choice = select_k(scores, bounds).first()
    if choice is None:
        raise ValueError("no number of clusters has a silhouette: all labels coincide")
    k = choice["selected_k"]
    fit = sweep.fits.get(k)
    if fit is None:
        fit = fcm.fit_fuzzy(sweep.points, [k], fuzziness=sweep.fuzziness, **fit_options)[k]
    return ChosenModel(k, fit.centres, fit.collapsed, scores)


def model_centres(spark: SparkSession, model: ChosenModel) -> DataFrame:
    return fcm.centres_table(spark, model.centres)
