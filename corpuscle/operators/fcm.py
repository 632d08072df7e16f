"""Fuzzy C-means as a distributed iteration, for one or many numbers of clusters.

One pass over the points serves every number of clusters ``k`` still running.
Per partition the pass adds up, for each k, the weighted points and weights of
every cluster and three scalars; the sums are merged by ``k`` and only
k x (dim + 1) numbers per k come back to the driver, where they become the next
centres. Memberships are never stored: they follow from the centres.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpuscle.functions.membership import (
    FUZZINESS,
    MAX_CENTRE_BYTES,
    distances,
    membership_matrix,
)
from corpuscle.functions.vectors import list_column, stored_matrix, sum_vector
from corpuscle.sources.shared import materialise, small_side

# Results depend on them.
SAMPLE_SIZE = 5000
CLUSTER_COUNTS = tuple(range(5, 26))
CLUSTER_BOUNDS = (10, 20)
MAX_PASSES = 150
TOLERANCE = 1e-5
SEED = 42
# Points whose sums are taken at a time: they stay in a core's cache.
POINTS_AT_ONCE = 1024
# Partitions whose sums one task merges.
MERGE_WIDTH = 512
# Memberships this close to 1/k on average mean that all centres have merged.
COLLAPSE_MARGIN = 1e-3


def sample_rows(rows: DataFrame, n: int = SAMPLE_SIZE, key: str = "doc_id", seed: int = SEED) -> DataFrame:
    """A random sample of exactly min(n, rows), the same one for any partitioning."""
    return rows.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary")), key).limit(n)


def stratified_rows(
    rows: DataFrame, strata: str, n: int = SAMPLE_SIZE, key: str = "doc_id", seed: int = SEED
) -> DataFrame:
    """A random sample of exactly min(n, rows) in which every stratum has its share.

    Seats are dealt by largest remainders, ties to the smaller stratum; null is a
    stratum of its own, first among ties. In a stratum rows stand in the order of
    ``sample_rows``. Rows with the same key and equal hash are taken in any order.
    """
    if n < 0:
        raise ValueError("n must not be negative")
    sizes = rows.groupBy(F.col(strata).alias("_stratum")).agg(F.count("*").cast("decimal(38,0)").alias("_size"))
    sizes = materialise(sizes, "strata")
    total = int(sizes.agg(F.coalesce(F.sum("_size"), F.lit(0))).first()[0])
    wanted = min(n, total)
    # Whole numbers throughout: size = share * total / wanted + rest.
    share = F.expr(f"_size * {wanted}BD div {max(1, total)}BD").cast("decimal(38,0)")
    shares = sizes.select("_stratum", share.alias("_share"), (F.col("_size") * wanted % max(1, total)).alias("_rest"))
    left = wanted - int(shares.agg(F.coalesce(F.sum("_share"), F.lit(0))).first()[0])
    # The strata with the largest remainders: a top-n, as many as there are seats left.
    extra = shares.orderBy(F.desc("_rest"), F.asc_nulls_first("_stratum")).limit(left).select(
        F.col("_stratum").alias("_more"), F.lit(1).alias("_seat")
    )
    seats = shares.join(extra, F.col("_stratum").eqNullSafe(F.col("_more")), "left").select(
        "_stratum", (F.col("_share") + F.coalesce("_seat", F.lit(0))).cast("bigint").alias("_seats")
    )
    seats = small_side(seats.filter("_seats > 0"), "seats")
    most = seats.agg(F.coalesce(F.max("_seats"), F.lit(0))).first()[0]
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary"))
    # Rows travel as one column, so that none of their names can clash.
    packed = rows.select(F.struct(*rows.columns).alias("_row"), F.col(strata).alias("_of"), order.alias("_hash"), F.col(key).alias("_key"))
    place = F.row_number().over(Window.partitionBy("_of").orderBy("_hash", "_key"))
    # The fixed bound lets Spark cut a stratum down before the shuffle, wherever its rows are.
    near = packed.withColumn("_place", place).filter(F.col("_place") <= most)
    chosen = near.join(seats, F.col("_of").eqNullSafe(F.col("_stratum"))).filter("_place <= _seats")
    return chosen.select("_row.*")


def start_key(key: str = "doc_id", seed: int = SEED) -> Column:
    """Per-row number from which the random first memberships are drawn."""
    return F.xxhash64(F.col(key), F.lit(seed))


@dataclass(frozen=True)
class FuzzyFit:
    """Result of one fit."""

    k: int
    centres: np.ndarray
    fpc: float
    objective: float
    passes: int
    converged: bool

    @property
    def collapsed(self) -> bool:
        return bool(self.fpc * self.k < 1.0 + COLLAPSE_MARGIN)


@dataclass
class _Running:
    """A fit in progress: the two latest centre sets (None means the random start)."""

    k: int
    before: np.ndarray | None = None
    now: np.ndarray | None = None
    fit: FuzzyFit | None = None


def _start_memberships(keys: np.ndarray, k: int) -> np.ndarray:
    """Uniform random rows that sum to 1, a function of the row key only."""
    x = keys.astype(np.uint64)[:, None] + np.arange(1, k + 1, dtype=np.uint64)[None, :] * np.uint64(
        0x9E3779B97F4A7C15
    )
    # 64-bit finaliser (public-domain SplitMix64 constants).
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    x = x ^ (x >> np.uint64(31))
    uniform = (x >> np.uint64(11)).astype(np.float64) / float(1 << 53)
    uniform = np.maximum(uniform, np.finfo(np.float64).eps)
    return uniform / uniform.sum(axis=1, keepdims=True)


def _partial_sums(states: list[tuple[int, np.ndarray | None, np.ndarray | None]], m: float):
    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            points = stored_matrix(batch["embedding"])
            start_keys = batch["start_key"].to_numpy(zero_copy_only=False)
            for first in range(0, len(points), POINTS_AT_ONCE):
                x = points[first : first + POINTS_AT_ONCE].astype(np.float64, copy=False)
                keys = start_keys[first : first + POINTS_AT_ONCE]
                add_slice(totals, x, keys)
        for k, sums in totals.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([k], pa.int32()), list_column(sums[None, :])], names=["k", "sums"]
            )

    def add_slice(totals: dict[int, np.ndarray], x: np.ndarray, keys: np.ndarray) -> None:
        squares = (x**2).sum(axis=1)
        for k, before, now in states:
            if now is None:
                u, previous, objective = _start_memberships(keys, k), None, 0.0
            else:
                dist = distances(x, now, squares)
                u = membership_matrix(dist, m)
                previous = (
                    _start_memberships(keys, k)
                    if before is None
                    else membership_matrix(distances(x, before, squares), m)
                )
                objective = float((previous**m * dist**2).sum())
            weights = u**m
            change = 0.0 if previous is None else float(((u - previous) ** 2).sum())
            sums = np.concatenate(
                [
                    (weights.T @ x).ravel(),
                    weights.sum(axis=0),
                    [float((u**2).sum()), objective, change, float(len(x))],
                ]
            )
            totals[k] = totals[k] + sums if k in totals else sums

    return add_up


def fit_pass(
    points: DataFrame, states: list[tuple[int, np.ndarray | None, np.ndarray | None]], m: float
) -> DataFrame:
    """One pass: rows ``k, sums`` for every k in ``states``.

    Every partition sends one row per k. Many partitions are first merged in
    groups, so that no task adds up the rows of all of them.
    """
    partial = points.select("embedding", "start_key").mapInArrow(
        _partial_sums(states, m), "k int, sums array<double>"
    )
    merged = sum_vector(F.col("sums")).alias("sums")
    if points.rdd.getNumPartitions() > MERGE_WIDTH:
        group = F.floor(F.spark_partition_id() / MERGE_WIDTH)
        partial = partial.groupBy("k", group.alias("_group")).agg(merged)
    return partial.groupBy("k").agg(merged)


def fit_fuzzy(
    points: DataFrame,
    cluster_counts: Sequence[int],
    *,
    fuzziness: float = FUZZINESS,
    tolerance: float = TOLERANCE,
    max_passes: int = MAX_PASSES,
) -> dict[int, FuzzyFit]:
    """Fit every number of clusters over the same passes.

    ``points`` has ``embedding`` and ``start_key``; it is read once per pass,
    so give a materialised table or cached rows. A fit ends when its
    memberships move less than ``tolerance`` (Frobenius norm) or after
    ``max_passes`` updates; the others go on.
    """
    if not fuzziness > 1.0:
        raise ValueError("fuzziness must be above 1")
    width = points.select(F.size("embedding").alias("d")).first()
    if width is None:
        raise ValueError("no points to cluster")
    if sum(cluster_counts) * width["d"] * 8 > MAX_CENTRE_BYTES:
        raise ValueError("centres of all cluster counts together are too large for the driver")

    running = {k: _Running(k) for k in cluster_counts}
    for done in range(max_passes + 1):
        live = [r for r in running.values() if r.fit is None]
        if not live:
            break
        rows = fit_pass(points, [(r.k, r.before, r.now) for r in live], fuzziness).collect()
        for row in rows:
            _advance(running[row["k"]], np.array(row["sums"]), done, tolerance, max_passes)
    return {k: r.fit for k, r in running.items()}


def _advance(run: _Running, sums: np.ndarray, done: int, tolerance: float, max_passes: int) -> None:
    k = run.k
    squares, objective, change, n = sums[-4:]
    if run.now is not None:
        converged = bool(np.sqrt(change) < tolerance)
        if converged or done == max_passes:
            run.fit = FuzzyFit(
                k, run.now, float(squares / n), float(objective), done, converged
            )
            return
    dim = (len(sums) - 4 - k) // k
    weighted, weight = sums[: k * dim].reshape(k, dim), sums[k * dim : k * dim + k]
    run.before, run.now = run.now, weighted / weight[:, None]


def centres_table(spark: SparkSession, centres: np.ndarray) -> DataFrame:
    """Centres as rows ``cluster, centre``."""
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(centres)]
    return spark.createDataFrame(rows, "cluster int, centre array<double>")
