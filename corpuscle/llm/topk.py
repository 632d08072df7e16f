"""Exact top-k inner products by a three-phase uniform threshold.

A vector's components are dealt into ``groups`` equal ranges; each gives every
candidate a local score, and the sum of local scores is its score.

1. Gather: every task keeps, per query and group, its ``k`` best local scores,
   and sends the best totals of these entries and the least local scores. The
   ``k``-th best total is a cutoff that no better answer falls below.
2. Broadcast the cutoff. With local scores counted from their minima, an entry
   can only reach it if one local score reaches the cutoff's equal share.
3. Entries that do are resolved exactly, and each task sends its best ``k``.

Scores that may pass 53 bits join no list: the cutoff stays safe without them,
and the third phase computes them in Python's whole numbers.

Queries are taken in blocks of bounded size, each sent to the tasks that scan
the candidates where they lie. No candidate is shuffled; a task sends at most
``k`` rows per query.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from functools import reduce
from math import ceil, floor, isfinite
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuscle.sources.shared import materialise

K = 10
SCALE = 1024.0
GROUPS = 4
# Queries of a block; with 1,024 dimensions it holds 32 MB.
QUERY_BLOCK = 4096
# Scores that a task computes at a time, and survivors it keeps before it prunes them.
SCORES_AT_ONCE = 1 << 20
KEPT_AT_ONCE = 1 << 20

_EXACT = float(1 << 53)
_LONG = 1 << 63


def usable(column: str) -> Column:
    """The vector is there and all of its components are finite."""
    c = F.col(column)
    return c.isNotNull() & F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))


def _matrix(vectors: pa.Array, scale: float, least_dim: int = 0) -> np.ndarray:
    """Rows of whole numbers ``floor(scale * x)``, short vectors filled with zeros; infinite beyond doubles."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore"):
        values = np.floor(scale * vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    dim = max([least_dim, *lengths.tolist()])
    if len(lengths) and (lengths == dim).all():
        return values.reshape(len(lengths), dim)
    out = np.zeros((len(lengths), dim))
    out[np.arange(dim) < lengths[:, None]] = values
    return out


def _whole(vector: list[float], scale: float) -> list[int]:
    """``floor(scale * x)`` of every component, of any size."""
    scaled = [scale * x for x in vector]
    return [floor(y) if isfinite(y) else floor(Fraction(x) * Fraction(scale)) for x, y in zip(vector, scaled, strict=True)]


class _Block:
    """Queries, their component ranges, and local scores of candidates."""

    def __init__(self, ids: np.ndarray, vectors: pa.Array, groups: int, scale: float):
        self.ids, self.vectors, self.scale = ids, vectors, scale
        self.matrix = _matrix(vectors, scale)
        self.cuts = np.linspace(0, self.matrix.shape[1], groups + 1).astype(int)
        self.largest = np.abs(self.matrix).max(axis=1, initial=0)

    def batches(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]]:
        """(ids, local scores by group, query and candidate, places of scores that may pass 53 bits, vectors).

        A query's own row and the scores at these places are minus infinity.
        """
        step = max(1, SCORES_AT_ONCE // max(1, len(self.ids)))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                ids = part.column(0).to_numpy(zero_copy_only=False)
                rows = _matrix(part.column(1), self.scale, self.matrix.shape[1])
                own = self.ids[:, None] == ids[None, :]
                largest = np.abs(rows).max(axis=1, initial=0)
                left_out, wild = own, np.zeros((0, 2), np.int64)
                if self.largest.max(initial=0) * largest.max(initial=0) * max(1, rows.shape[1]) >= _EXACT:
                    with np.errstate(over="ignore", invalid="ignore"):
                        # Zero times infinity is not a number: such a pair isn't tame either.
                        tame = self.largest[:, None] * largest[None, :] * max(1, rows.shape[1]) < _EXACT
                    wild = np.argwhere(~tame & ~own)
                    left_out = own | ~tame
                with np.errstate(over="ignore", invalid="ignore"):
                    local = np.stack(
                        [self.matrix[:, a:b] @ rows[:, a : min(b, self.matrix.shape[1])].T for a, b in zip(self.cuts, self.cuts[1:], strict=False)]
                    )
                yield ids, np.where(left_out, -np.inf, local), wild, part.column(1)

    def exact(self, wild: np.ndarray, vectors: pa.Array) -> Iterator[tuple[int, int, int]]:
        """(query, candidate, score) at the places in ``wild``."""
        rows = {int(c): _whole(vectors[int(c)].as_py(), self.scale) for c in np.unique(wild[:, 1])}
        asked = {int(q): _whole(self.vectors[int(q)].as_py(), self.scale) for q in np.unique(wild[:, 0])}
        for q, c in wild.tolist():
            # The shorter vector ends the sum: what it lacks is zero.
            yield q, c, sum(map(mul, asked[q], rows[c]))


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` largest along the last axis."""
    if scores.shape[-1] <= k:
        return np.broadcast_to(np.arange(scores.shape[-1]), scores.shape).copy()
    return np.argpartition(scores, scores.shape[-1] - k, axis=-1)[..., -k:]


def _gather(candidates: DataFrame, block: _Block, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per query the cutoff (minus infinity if fewer than ``k`` entries), and the least local scores."""
    groups = len(block.cuts) - 1

    def local_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(block.ids)
        least = np.full((groups, n), np.inf)
        kept = np.full((groups, n, 0), -np.inf)  # local scores on the lists
        totals = np.full((groups, n, 0), -np.inf)
        places = np.zeros((groups, n, 0), dtype=np.int64)
        seen = 0
        for ids, local, _, _ in block.batches(batches):
            total = local.sum(axis=0)
            least = np.minimum(least, np.where(np.isinf(local), np.inf, local).min(axis=2, initial=np.inf))
            top = _best(local, k)
            kept = np.concatenate([kept, np.take_along_axis(local, top, 2)], axis=2)
            totals = np.concatenate([totals, np.take_along_axis(np.broadcast_to(total, local.shape), top, 2)], axis=2)
            places = np.concatenate([places, top + seen], axis=2)
            top = _best(kept, k)
            kept, totals, places = (np.take_along_axis(x, top, 2) for x in (kept, totals, places))
            seen += len(ids)
        if not seen:
            return
        # An entry may be on the lists of several groups; it counts once.
        flat_places = np.moveaxis(places, 0, 1).reshape(n, -1)
        flat_totals = np.moveaxis(totals, 0, 1).reshape(n, -1)
        out = []
        for i in range(n):
            _, first = np.unique(flat_places[i], return_index=True)
            found = np.sort(flat_totals[i, first])[::-1][:k]
            out.append(found[np.isfinite(found)].tolist())
        yield pa.record_batch(
            [pa.array(range(n), pa.int32()), pa.array(out, pa.list_(pa.float64())), pa.array(least.T.tolist(), pa.list_(pa.float64()))],
            names=["query", "totals", "least"],
        )

    lists = candidates.mapInArrow(local_lists, "query int, totals array<double>, least array<double>")
    rows = (
        lists.groupBy("query")
        .agg(
            F.slice(F.sort_array(F.flatten(F.collect_list("totals")), asc=False), 1, k).alias("totals"),
            F.array(*[F.min(F.col("least")[g]) for g in range(groups)]).alias("least"),
        )
        .collect()  # one row per query of the block
    )
    cutoff = np.full(len(block.ids), -np.inf)
    least = np.zeros((groups, len(block.ids)))
    for row in rows:
        if len(row["totals"]) == k:
            cutoff[row["query"]] = row["totals"][-1]
        least[:, row["query"]] = [x if np.isfinite(x) else 0.0 for x in row["least"]]
    return cutoff, least


def _prune(query: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` best of each query, ties to the smaller id."""
    order = np.lexsort((ids, ~scores, query))  # ~x falls as x rises, and doesn't overflow
    query, ids, scores = query[order], ids[order], scores[order]
    first = np.flatnonzero(np.concatenate(([True], query[1:] != query[:-1]))) if len(query) else np.zeros(0, np.int64)
    rank = np.arange(len(query)) - np.repeat(first, np.diff(np.append(first, len(query))))
    keep = rank < k
    return query[keep], ids[keep], scores[keep]


def _resolve(candidates: DataFrame, block: _Block, cutoff: np.ndarray, least: np.ndarray, k: int) -> DataFrame:
    groups = len(least)
    share = least + (cutoff - least.sum(axis=0)) / groups

    def survivors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query, found, scores = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        for ids, local, wild, vectors in block.batches(batches):
            # Half a unit: local scores are whole numbers, shares are rounded.
            q, c = np.nonzero((local >= share[:, :, None] - 0.5).any(axis=0))
            total = local[:, q, c].sum(axis=0)
            keep = (total >= cutoff[q]) & np.isfinite(total)
            q, c, total = q[keep], c[keep], total[keep].astype(np.int64)
            if len(wild):
                more = [(i, j, x) for i, j, x in block.exact(wild, vectors) if x >= cutoff[i]]
                if any(not -_LONG <= x < _LONG for _, _, x in more):
                    raise OverflowError("a score is beyond 64 bits")
                more = np.array(more, np.int64).reshape(-1, 3)
                q, c, total = (np.concatenate(x) for x in ((q, more[:, 0]), (c, more[:, 1]), (total, more[:, 2])))
            query, found, scores = (np.concatenate(x) for x in ((query, q), (found, ids[c]), (scores, total)))
            if len(query) > KEPT_AT_ONCE:
                query, found, scores = _prune(query, found, scores, k)
        query, found, scores = _prune(query, found, scores, k)
        yield pa.record_batch(
            [pa.array(block.ids[query]), pa.array(found), pa.array(scores)], names=["query_id", "vec_id", "score"]
        )

    return candidates.mapInArrow(survivors, "query_id bigint, vec_id bigint, score bigint")


def top_k(
    queries: DataFrame, candidates: DataFrame, *, key: str = "vec_id", vector: str = "embedding",
    k: int = K, scale: float = SCALE, groups: int = GROUPS, query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` best candidates, all if fewer.

    Scores are inner products of ``floor(scale * x)``, ties go to the smaller
    key. Rows without key, without vector or with null or non-finite components
    take no part; vectors of different length are filled with zeros. A key that
    is repeated among the queries is one query (its smallest vector); every
    candidate row with another key counts, repeated or not. Scores are exact for
    finite components of any size; one that could be an answer and is beyond 64
    bits raises an error. An empty side gives no rows; other columns are ignored.
    """
    named = lambda df: df.select(F.col(key).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("v")).filter(
        F.col("vec_id").isNotNull() & usable("v")
    )
    candidates = named(candidates)
    asked = named(queries).groupBy("vec_id").agg(F.min("v").alias("v"))
    asked = materialise(asked, "topk-queries")
    blocks = max(1, ceil(asked.count() / query_block))
    parts = []
    for number in range(blocks):
        # About ``query_block`` rows: the size of a block does not grow with the data.
        rows = asked.filter(F.expr(f"pmod(xxhash64(vec_id), {blocks}) = {number}")).toArrow()
        if not rows.num_rows:
            continue
        block = _Block(rows.column(0).to_numpy(), rows.column(1).combine_chunks(), groups, scale)
        cutoff, least = _gather(candidates, block, k)
        parts.append(materialise(_resolve(candidates, block, cutoff, least, k), "topk-answers"))
    if not parts:
        return asked.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    answers = reduce(DataFrame.unionByName, parts).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return answers.select("query_id", "rank", "vec_id", "score")
