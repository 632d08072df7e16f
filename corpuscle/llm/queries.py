"""Registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuscle.llm import codes, conversations, decontaminate, exact_dedup, html_text, jaccard, licenses, ordinal, packing, topk, toxicity, urls, warc
from corpuscle.session import ship_package
from corpuscle.sources.shared import fresh_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


GRADES = 3


def grade() -> Column:
    """Graded ratings from the two labels: 0 bad, 1 good but toxic, 2 good."""
    return F.col("quality") * (2 - F.col("toxic"))


def op1_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return ordinal.score(docs, ordinal.fit(docs, _table(spark, sf_dir, "labels"), grade(), GRADES))


def op2_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_table(spark, sf_dir, "pages"))


def op3_url_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(_table(spark, sf_dir, "pages"), urls.fit(urls.labelled_urls(spark)))


def op4_uniform_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors.filter("vec_id % 100 = 0"), vectors)


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_groups(_table(spark, sf_dir, "documents"))


def op6_weak_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


def op7_pigeonhole_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_hits(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), short_within=True)


def op8_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"), fresh_path(spark, "warc"))


def op9_license_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op11_hilbert_block_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.encode(_table(spark, sf_dir, "embeddings"))


def op12_block_table_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    return conversations.repair(conversations.damage(turns), turns)


def op13_digest_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.find_copies(_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_ordinal_quality,
        op2_html_blocks,
        op3_url_trees,
        op4_uniform_threshold_topk,
        op5_ngram_jaccard,
        op6_weak_toxicity,
        op7_pigeonhole_decontamination,
        op8_warc_chunks,
        op9_license_diagonals,
        op10_best_fit_packing,
        op11_hilbert_block_codes,
        op12_block_table_repair,
        op13_digest_runs,
        pipeline,
    )

    def ready(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return query(spark, sf_dir)

        return run

    return {query.__name__: ready(query) for query in found}
