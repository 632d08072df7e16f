"""Nearest documents for a batch of queries."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from corpuscle.functions.membership import distances
from corpuscle.functions.text import strip_blanks
from corpuscle.functions.vectors import matrix
from corpuscle.operators.matching import top_matches
from corpuscle.sources.shared import materialise, small_side

# Fixed values.
DEFAULT_RESULTS = 5
MAX_RESULTS = 20
SIMILARITY_DIGITS = 4
# Added to upper bounds: more than rounding takes from unit vectors' products.
_BOUND_SLACK = 1e-9


def nearest_documents(
    documents: DataFrame,
    queries: DataFrame,
    n: int = DEFAULT_RESULTS,
    *,
    doc_id: str = "doc_id",
    query_id: str = "seq",
    query_vector: str = "vector",
    **limits: int,
) -> DataFrame:
    """Exact search: ``query, doc_id, id, score`` with ``id`` the rank from 1.

    ``documents`` and ``queries`` hold unit vectors; no bucket restricts the
    search, every document is compared.
    """
    found = top_matches(
        documents,
        queries,
        n,
        entry_id=doc_id,
        query_id=query_id,
        query_vector=query_vector,
        **limits,
    )
    return _as_hits(found, query_id)


def _as_hits(found: DataFrame, query_id: str) -> DataFrame:
    return found.select(
        F.col("query").alias(query_id),
        F.col("entry").alias("doc_id"),
        F.col("rank").alias("id"),
        "score",
    )


def _probes(centres: np.ndarray, nprobe: int):
    @arrow_udf("array<int>")
    def probe(vector: pa.Array) -> pa.Array:
        if len(vector) == 0:
            return pa.array([], type=pa.list_(pa.int32()))
        order = np.argsort(distances(matrix(vector), centres), axis=1, kind="stable")
        return pa.array(list(order[:, :nprobe].astype(np.int32)), type=pa.list_(pa.int32()))

    return probe


def nearest_documents_pruned(
    documents: DataFrame,
    queries: DataFrame,
    centres: np.ndarray,
    nprobe: int,
    n: int = DEFAULT_RESULTS,
    *,
    doc_id: str = "doc_id",
    query_id: str = "seq",
    query_vector: str = "vector",
    **limits: int,
) -> DataFrame:
    """Approximate search: only documents of the ``nprobe`` clusters nearest to the query.

    ``documents`` carry ``dominant_cluster``. Each query visits its clusters
    separately; the best of all visits are merged.
    """
    visits = queries.select(
        query_id,
        query_vector,
        F.explode(_probes(centres, nprobe)(F.col(query_vector))).alias("dominant_cluster"),
    )
    found = top_matches(
        documents,
        visits,
        n,
        entry_id=doc_id,
        query_id=query_id,
        query_vector=query_vector,
        bucket="dominant_cluster",
        several_buckets=True,
        **limits,
    )
    return _as_hits(found, query_id)


class Cones(NamedTuple):
    """What bounds the documents of each cluster that has any: how far they reach along
    the centre's direction, least and most, and their largest length."""

    cluster: np.ndarray
    direction: np.ndarray
    least: np.ndarray
    most: np.ndarray
    length: np.ndarray

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The largest inner product that each query can have with a document of each cluster.

        Query and document are split along the centre's direction and across it; the
        parts across meet in the product of their lengths at most. The sum is
        concave in the document's part along, so its peak is cut to the range.
        """
        along = queries @ self.direction.T
        across = np.sqrt(np.maximum((queries**2).sum(axis=1)[:, None] - along**2, 0.0))
        size = np.sqrt((queries**2).sum(axis=1))[:, None]
        peak = np.divide(along * self.length, size, out=np.zeros_like(along), where=size > 0)
        at = np.clip(peak, self.least, self.most)
        return along * at + across * np.sqrt(np.maximum(self.length**2 - at**2, 0.0)) + _BOUND_SLACK


def cluster_cones(documents: DataFrame, centres: np.ndarray, vector: str = "embedding") -> Cones:
    """Measure the clusters of ``documents`` (``dominant_cluster``): one row per cluster reaches the driver."""
    norms = np.linalg.norm(centres, axis=1, keepdims=True)
    directions = np.divide(centres, norms, out=np.zeros_like(centres, dtype=float), where=norms > 0)

    @arrow_udf("struct<along: double, length: double>")
    def measure(cluster: pa.Array, rows: pa.Array) -> pa.Array:
        x = matrix(rows) if len(rows) else np.zeros((0, directions.shape[1]))
        own = directions[cluster.to_numpy(zero_copy_only=False).astype(int)]
        parts = [pa.array((x * own).sum(axis=1)), pa.array(np.linalg.norm(x, axis=1))]
        return pa.StructArray.from_arrays(parts, ["along", "length"])

    measured = documents.select("dominant_cluster", measure("dominant_cluster", vector).alias("m"))
    rows = (
        measured.groupBy("dominant_cluster")
        .agg(F.min("m.along"), F.max("m.along"), F.max("m.length"))
        .orderBy("dominant_cluster")
        .collect()
    )
    cluster = np.array([r[0] for r in rows], dtype=int)
    least, most, length = (np.array([r[i] for r in rows], dtype=float) for i in (1, 2, 3))
    return Cones(cluster, directions[cluster], least, most, np.maximum(length, np.maximum(np.abs(least), np.abs(most))))


def nearest_documents_certified(
    documents: DataFrame,
    queries: DataFrame,
    centres: np.ndarray,
    n: int = DEFAULT_RESULTS,
    *,
    doc_id: str = "doc_id",
    query_id: str = "seq",
    query_vector: str = "vector",
    cones: Cones | None = None,
    **limits: int,
) -> tuple[DataFrame, DataFrame]:
    """Exact search that skips clusters: hits as of ``nearest_documents``, and ``clusters_read`` per query.

    ``documents`` carry ``dominant_cluster``; stored partitioned by it, a round
    reads only the folders of the clusters it visits. A query visits clusters in
    the order of what their cones let a document score at most, twice as many a
    round, until its ``n``-th best is above what the next cluster can hold; an
    equal score is not enough, as ties go to the smaller id. Every hit of the
    exact search is found, whatever the centres are; poor clusters only cost time.
    """
    cones = cluster_cones(documents, centres) if cones is None else cones
    k = len(cones.cluster)

    @arrow_udf("array<struct<cluster: int, bound: double>>")
    def ordered(rows: pa.Array) -> pa.Array:
        bound = cones.bounds(matrix(rows)) if len(rows) else np.zeros((0, k))
        order = np.argsort(-bound, axis=1, kind="stable")
        cells = pa.StructArray.from_arrays(
            [pa.array(cones.cluster[order].ravel().astype(np.int32)), pa.array(np.take_along_axis(bound, order, 1).ravel())],
            ["cluster", "bound"],
        )
        return pa.ListArray.from_arrays(pa.array(np.arange(len(order) + 1, dtype=np.int32) * k), cells)

    open_ = queries.select(F.col(query_id).alias("query"), F.col(query_vector).alias("vector"))
    open_ = materialise(open_.withColumn("order", ordered("vector")), "certified-queries")
    read = open_.select(F.col("query").alias(query_id), F.lit(0).alias("clusters_read")).limit(0)
    best: DataFrame | None = None
    start, width = 0, 1
    while start < k and not open_.isEmpty():
        end = min(k, start + width)
        visits = open_.select("query", "vector", F.explode(F.slice("order", start + 1, end - start)).alias("visit"))
        visits = visits.select("query", "vector", F.col("visit.cluster").alias("dominant_cluster"))
        # As many numbers as there are clusters, at most.
        wanted = [r[0] for r in visits.select("dominant_cluster").distinct().collect()]
        found = top_matches(
            documents.filter(F.col("dominant_cluster").isin(wanted)),
            visits,
            n,
            entry_id=doc_id,
            query_id="query",
            query_vector="vector",
            bucket="dominant_cluster",
            several_buckets=True,
            **limits,
        ).select("query", "entry", "score")
        found = found if best is None else found.unionByName(best.select("query", "entry", "score"))
        rank = Window.partitionBy("query").orderBy(F.desc("score"), "entry")
        found = found.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= n)
        best = materialise(found, "certified-best")
        nth = best.filter(F.col("rank") == n).select("query", F.col("score").alias("nth"))
        judged = open_.join(nth, "query", "left")
        more = F.col("nth").isNull() | (F.col("order")[end]["bound"] >= F.col("nth")) if end < k else F.lit(False)
        judged = materialise(judged.withColumn("more", more), "certified-judged")
        done = judged.filter("NOT more").select(F.col("query").alias(query_id), F.lit(end).alias("clusters_read"))
        read = read.unionByName(done)
        open_ = judged.filter("more").select("query", "vector", "order")
        start, width = end, 2 * width
    read = read.unionByName(open_.select(F.col("query").alias(query_id), F.lit(start).alias("clusters_read")))
    if best is None:
        kinds = {f.name: f.dataType for f in documents.schema.fields}
        empty = queries.select(F.col(query_id).alias("query"), F.lit(None).cast(kinds[doc_id]).alias("entry"), F.lit(0.0).alias("score"), F.lit(0).alias("rank"))
        best = empty.limit(0)
    return _as_hits(best, query_id), read


def search_hits(found: DataFrame, texts: DataFrame, query_id: str = "seq") -> DataFrame:
    """Shape hits: ``id, category, similarity, text`` per query, texts joined last.

    ``found`` has n rows per query, without texts; where that is small, the
    texts are scanned and matched in place, without a shuffle.
    """
    found = small_side(found, "found")
    return texts.select("doc_id", "category", "text").join(found, "doc_id").select(
        query_id,
        "id",
        "category",
        F.round("score", SIMILARITY_DIGITS).alias("similarity"),
        strip_blanks(F.col("text")).alias("text"),
    )


def hit_lists(hits: DataFrame, query_id: str = "seq") -> DataFrame:
    """One row per query with its hits as an array in rank order."""
    hit = F.struct("id", "category", "similarity", "text")
    return hits.groupBy(query_id).agg(F.array_sort(F.collect_list(hit)).alias("result"))
