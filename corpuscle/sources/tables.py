"""The stored tables: vector collection, cluster artifact, summary."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuscle.functions.vectors import l2_normalize
from corpuscle.operators.ordering import with_dense_index


def table_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    return True


def write_collection(embedded: DataFrame, path: str, order: str = "doc_seq") -> None:
    """Write ``doc_id, embedding, text, metadata(category, doc_index)``, replacing the table.

    ``doc_index`` is the position in load order, from 0.
    """
    indexed = with_dense_index(embedded, order, "doc_index")
    indexed.select(
        "doc_id",
        F.col("embedding").cast("array<float>").alias("embedding"),
        "text",
        F.struct("category", F.col("doc_index").cast("bigint").alias("doc_index")).alias("metadata"),
    ).write.mode("overwrite").parquet(path)


def open_collection(spark: SparkSession, path: str) -> DataFrame:
    """The stored collection; fails if there is none."""
    return spark.read.parquet(path)


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, category, doc_index, embedding`` scaled to unit length; no text is read."""
    return open_collection(spark, path).select(
        "doc_id",
        F.col("metadata.category").alias("category"),
        F.col("metadata.doc_index").alias("doc_index"),
        l2_normalize(F.col("embedding")).cast("array<float>").alias("embedding"),
    )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, category, embedding, text``, as the search needs them."""
    return open_collection(spark, path).select(
        "doc_id", F.col("metadata.category").alias("category"), "embedding", "text"
    )


def save_clusters(memberships: DataFrame, centres: DataFrame, path: str) -> None:
    memberships.select("doc_id", "category", "memberships").write.mode("overwrite").parquet(
        f"{path}/memberships"
    )
    centres.select("cluster", "centre").write.mode("overwrite").parquet(f"{path}/centres")


def load_clusters(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Memberships and centres."""
    return spark.read.parquet(f"{path}/memberships"), spark.read.parquet(f"{path}/centres")


def save_summary(summary: DataFrame, path: str) -> None:
    """The summary row as one JSON document."""
    summary.coalesce(1).write.mode("overwrite").json(path)


def load_summary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SUMMARY_SCHEMA).json(path)


SUMMARY_SCHEMA = (
    "n_clusters int, n_docs bigint, fuzziness_m double, silhouette_scores map<string,double>, "
    "top_docs_per_cluster map<string,array<struct<doc_id:string,category:string,membership:double>>>, "
    "boundary_documents array<struct<doc_id:string,category:string,entropy:double,"
    "memberships:map<string,double>>>"
)
