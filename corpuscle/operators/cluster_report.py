"""Memberships of a whole corpus and what they say about clusters and documents."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuscle.functions import membership as mb

# Sizes of the reports.
TOP_DOCS = 10
BOUNDARY_DOCS = 20
BOUNDARY_CLUSTERS = 5
SHOWN_BOUNDARY_DOCS = 3


def predict_memberships(
    vectors: DataFrame, centres: np.ndarray, fuzziness: float = mb.FUZZINESS
) -> DataFrame:
    """``doc_id, category, memberships``: one narrow stage, no shuffle."""
    assign = mb.memberships(centres, fuzziness)
    return vectors.select("doc_id", "category", assign("embedding").alias("memberships"))


def top_docs_per_cluster(memberships: DataFrame, n: int = TOP_DOCS) -> DataFrame:
    """The ``n`` strongest documents of every cluster.

    The rank limit is applied before the shuffle too, so each cluster
    receives at most ``n`` rows per input partition.
    """
    # The outer form: a plain posexplode would test every array in a filter
    # below, and compute memberships that come from a UDF a second time.
    cells = F.posexplode_outer("memberships").alias("cluster", "membership")
    strongest = Window.partitionBy("cluster").orderBy(F.desc("membership"), "doc_id")
    return (
        memberships.select("doc_id", "category", cells)
        .withColumn("rank", F.row_number().over(strongest))
        .filter(F.col("rank") <= n)
        .select("cluster", "rank", "doc_id", "category", "membership")
    )


def boundary_documents(
    memberships: DataFrame, n: int = BOUNDARY_DOCS, clusters: int = BOUNDARY_CLUSTERS
) -> DataFrame:
    """The ``n`` documents of highest entropy with their largest memberships."""
    return (
        memberships.withColumn("entropy", mb.entropy(F.col("memberships")))
        .orderBy(F.desc("entropy"), "doc_id")
        .limit(n)
        .select(
            "doc_id",
            "category",
            "entropy",
            F.map_from_entries(
                mb.largest_memberships(F.col("memberships"), clusters)
            ).alias("memberships"),
        )
    )


def boundary_report(boundary: DataFrame, n: int = SHOWN_BOUNDARY_DOCS) -> DataFrame:
    """The first ``n`` boundary documents, one row per cluster shown."""
    return (
        boundary.orderBy(F.desc("entropy"), "doc_id")
        .limit(n)
        .select("doc_id", "category", F.explode("memberships").alias("cluster", "membership"))
    )


def cluster_quality(memberships: DataFrame) -> DataFrame:
    """One row: documents, clusters in use as hard label, partition coefficient."""
    label = mb.hard_label(F.col("memberships"))
    return memberships.agg(
        F.count("*").alias("n_docs"),
        F.count_distinct(label).alias("n_labels"),
        mb.partition_coefficient(F.col("memberships")).alias("fpc"),
    )


def summary(
    memberships: DataFrame,
    scores: DataFrame,
    n_clusters: int,
    fuzziness: float = mb.FUZZINESS,
) -> DataFrame:
    """One nested row that describes a clustering.

    ``scores`` has ``k, silhouette``. Only the report rows (n per cluster, n
    boundary documents) are gathered into the row, never the documents.
    """
    top_doc = F.struct("rank", "doc_id", "category", "membership")
    ranked = F.array_sort(F.collect_list(top_doc))
    without_rank = F.transform(
        ranked, lambda d: F.struct(d["doc_id"], d["category"], d["membership"])
    )
    per_cluster = top_docs_per_cluster(memberships).groupBy("cluster").agg(
        without_rank.alias("docs")
    )
    top_docs = per_cluster.agg(
        F.map_from_entries(
            F.array_sort(F.collect_list(F.struct(F.col("cluster").cast("string"), "docs")))
        ).alias("top_docs_per_cluster")
    )
    boundary_doc = F.struct(
        (-F.col("entropy")).alias("order"), "doc_id", "category", "entropy", "memberships"
    )
    boundary = boundary_documents(memberships).agg(
        F.collect_list(boundary_doc).alias("docs")
    ).select(
        F.transform(
            F.sort_array(F.transform("docs", _sortable_boundary)),
            lambda d: F.struct(
                d["doc_id"].alias("doc_id"),
                d["category"].alias("category"),
                d["entropy"].alias("entropy"),
                F.map_from_entries(d["memberships"]).alias("memberships"),
            ),
        ).alias("boundary_documents")
    )
    silhouette_scores = scores.agg(
        F.map_from_entries(
            F.transform(
                F.array_sort(F.collect_list(F.struct("k", "silhouette"))),
                lambda s: F.struct(s["k"].cast("string"), s["silhouette"]),
            )
        ).alias("silhouette_scores")
    )
    return memberships.agg(
        F.lit(n_clusters).alias("n_clusters"),
        F.count("*").alias("n_docs"),
        F.lit(fuzziness).alias("fuzziness_m"),
    ).select(
        "*",
        silhouette_scores.scalar().alias("silhouette_scores"),
        top_docs.scalar().alias("top_docs_per_cluster"),
        boundary.scalar().alias("boundary_documents"),
    )


def _sortable_boundary(d):
    # Maps cannot be compared, entries can.
    return F.struct(
        d["order"], d["doc_id"], d["category"], d["entropy"],
        F.map_entries(d["memberships"]).alias("memberships"),
    )
