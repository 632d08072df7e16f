"""The registered queries: every operator over whole input tables.

Roles of the tables: ``documents`` is the corpus (``source`` the category,
``doc_id`` the load order), ``embeddings`` holds vectors and, in ``vec_id``
order, a query log; ``label`` means serve as cluster centres where the result
must not depend on a random start; user turns of ``conversations`` are text
queries.
"""

from __future__ import annotations

import functools
import io
import itertools
import tarfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuscle.functions import membership as mb
from corpuscle.functions import text as tx
from corpuscle.functions import vectors as vc
from corpuscle.operators import (
    cache,
    cluster_report,
    corpus,
    encode,
    fcm,
    model,
    ordering,
    replay,
    requests,
    search,
    silhouette,
    term_model,
    thresholds,
)
from corpuscle.plans.pipeline import run_build
from corpuscle.session import bound_batches, drop_shuffles, ship_package
from corpuscle.sources import articles, cache_store, tables
from corpuscle.sources.shared import fresh_path, materialise, spread
from corpuscle.streaming import keyed_stream
from corpuscle.streaming.query_stream import QueryStream

Query = Callable[[SparkSession, str], DataFrame]

_REGISTERED: dict[str, Query] = {}

# Parameters of the registered queries; the SQL uses the same.
CACHE_THRESHOLD = 0.3
LOOSE_THRESHOLD = 0.2
REPLAY_THRESHOLD = 0.25
SWEEP_THRESHOLDS = (0.20, 0.25, 0.30, 0.35, 0.40)
TOP_N = 5
NPROBE = 8
SAMPLED = 100
# Rows of a file of a streamed log, about.
LOG_FILE_ROWS = 100_000


def register(query: Query) -> Query:
    _REGISTERED[query.__name__] = query
    return query


def queries() -> dict[str, Query]:
    def ready(query: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            bound_batches(spark)
            drop_shuffles(spark)
            return query(spark, sf_dir)

        return run

    return {name: ready(query) for name, query in _REGISTERED.items()}


# --- inputs ---------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus, spread out where it is one unsplittable file."""
    return spread(table(spark, sf_dir, "documents"), "doc_id")


def wrapped_text() -> Column:
    """The text of a document as it would arrive: headers, quotes, signature."""
    return F.concat(
        F.lit("From: writer"), F.col("doc_id"), F.lit("@example.org\nX-Lang : "), F.col("lang"),
        F.lit("\nSubject\nArticle-I.D.: "), F.col("doc_id"), F.lit("\n\n  "), F.col("text"),
        F.lit("\n\n\n\n > earlier words of "), F.col("source"), F.lit("\nlast line\n-- \nsent by "),
        F.col("source"), F.lit("\n"),
    )


def raw_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_seq, doc_id, category, text`` with the text wrapped."""
    return documents(spark, sf_dir).select(
        F.col("doc_id").alias("doc_seq"),
        F.concat_ws("/", "source", "doc_id").alias("doc_id"),
        F.col("source").alias("category"),
        wrapped_text().alias("text"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, category, embedding`` with text ids, as the cluster jobs take them."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("doc_id"),
        F.col("label").cast("string").alias("category"),
        "embedding",
    )


def label_centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "embeddings")
        .groupBy(F.col("label").alias("cluster"))
        .agg(vc.mean_vector(F.col("embedding")).alias("centre"))
    )


def centres(spark: SparkSession, sf_dir: str) -> np.ndarray:
    return mb.collect_centres(label_centres(spark, sf_dir))


def memberships(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_report.predict_memberships(vectors(spark, sf_dir), centres(spark, sf_dir))


def query_log(spark: SparkSession, sf_dir: str, flushes: bool = False) -> DataFrame:
    """The vectors as a log in ``vec_id`` order; with flushes, some rows empty the cache."""
    op = F.when(F.col("vec_id") % 170 == 169, "flush").otherwise("query") if flushes else F.lit("query")
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("seq"),
        op.alias("op"),
        F.concat(F.lit("query "), F.col("vec_id")).alias("query"),
        F.col("embedding").alias("vector"),
        F.lit(None).cast("double").alias("threshold"),
        (F.col("vec_id") % 3 + 1).cast("int").alias("n_results"),
    )


def cached_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors as cache entries under their dominant cluster."""
    rows = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("seq"),
        F.concat(F.lit("query "), F.col("vec_id")).alias("query"),
        F.col("embedding").alias("vector"),
        F.array(
            F.struct(
                F.lit(1).alias("id"),
                F.col("label").cast("string").alias("category"),
                F.lit(1.0).alias("similarity"),
                F.col("vec_id").cast("string").alias("text"),
            )
        ).alias("result"),
    )
    return cache.assign_clusters(rows, centres(spark, sf_dir))


def cache_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many queries as entries: each vector read backwards; some set a threshold."""
    rows = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("seq"),
        F.reverse("embedding").alias("vector"),
        F.when(F.col("vec_id") % 4 == 0, F.lit(LOOSE_THRESHOLD)).alias("threshold"),
    )
    return cache.assign_clusters(rows, centres(spark, sf_dir)).drop("membership_vector")


def documents_with_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, category, embedding, text`` of all vectors; null where there is no document."""
    docs = table(spark, sf_dir, "documents")
    vecs = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    return vecs.join(docs, "doc_id", "left").select(
        "doc_id", F.col("source").alias("category"), "embedding", "text"
    )


def flat_hits(result: Column) -> Column:
    """A result list as one line of text."""
    return F.array_join(
        F.transform(
            result,
            lambda h: F.concat_ws(
                ":", h["id"], h["category"], F.format_string("%.4f", h["similarity"]), F.length(h["text"])
            ),
        ),
        "|",
    )


# --- articles and cleaning ------------------------------------------------


@register
def article_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths to category, file name and id; short paths dropped, deep ones cut."""
    tail = F.when(F.col("doc_id") % 5 == 1, "/part").otherwise("")
    path = F.when(F.col("doc_id") % 7 == 3, F.concat_ws("/", F.lit("root"), "doc_id")).otherwise(
        F.concat(F.concat_ws("/", F.lit("root"), "source", "doc_id"), tail)
    )
    files = table(spark, sf_dir, "documents").select(path.alias("path"))
    return corpus.article_paths(files)


@register
def decode_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes to text, one character per byte."""
    files = table(spark, sf_dir, "documents").select(
        "doc_id", F.col("text").cast("binary").alias("content")
    )
    return corpus.decode_articles(files)


@register
def header_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_articles(spark, sf_dir)
    return raw.select("doc_seq", tx.strip_headers(F.col("text")).alias("body"))


@register
def quote_sig_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_articles(spark, sf_dir)
    return raw.select("doc_seq", tx.strip_quotes_and_signature(F.col("text")).alias("body"))


@register
def whitespace(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_articles(spark, sf_dir)
    return raw.select("doc_seq", tx.normalize_whitespace(F.col("text")).alias("body"))


@register
def clean_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.clean_corpus(raw_articles(spark, sf_dir))


@register
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", tx.token_count(F.col("text")).alias("tokens"))


@register
def token_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return corpus.keep_long_enough(docs).select("doc_id")


@register
def fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", tx.fingerprint(F.col("text"), tx.FINGERPRINT_CHARS).alias("fingerprint"))


@register
def dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return corpus.drop_copies(docs, "doc_id")


@register
def usable_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned, long enough, first of its fingerprint."""
    return corpus.usable_corpus(raw_articles(spark, sf_dir))


@register
def load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.load_report(raw_articles(spark, sf_dir))


@register
def first_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trial run: the first 500 usable documents in load order."""
    usable = corpus.usable_corpus(raw_articles(spark, sf_dir))
    return corpus.first_documents(usable).select("doc_seq", "doc_id")


@register
def corpus_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Position of every usable document in load order."""
    usable = materialise(
        corpus.usable_corpus(raw_articles(spark, sf_dir)).select("doc_seq", "doc_id"), "positions"
    )
    return ordering.with_dense_index(usable, "doc_seq", "doc_index")


def _archive_writer(path: str):
    """Per partition, stream its documents into one archive named by its first id."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = articles.open_location(path)
        fs.create_dir(folder, recursive=True)
        files = (
            file
            for batch in batches
            for file in zip(*(batch[c].to_pylist() for c in ("doc_id", "source", "content")))
        )
        count = 0
        for first in files:
            name = f"{folder}/{first[0]:012d}.tar.gz"
            with fs.open_output_stream(name, compression=None) as out:
                with tarfile.open(fileobj=out, mode="w|gz") as archive:
                    for doc, source, content in itertools.chain([first], files):
                        info = tarfile.TarInfo(f"root/{source}/{doc}")
                        info.size = len(content)
                        archive.addfile(info, io.BytesIO(content))
                        count += 1
        yield pa.RecordBatch.from_arrays([pa.array([count], pa.int64())], names=["n"])

    return write


@register
def articles_from_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` packed into compressed archives by Spark, then read back as articles."""
    path = fresh_path(spark, "archives")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", F.col("text").cast("binary").alias("content")
    )
    packed = docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    packed.mapInArrow(_archive_writer(path), "n bigint").agg(F.sum("n")).first()
    read = articles.read_archives(spark, path)
    return ordering.with_dense_index(read, "doc_seq", "position").select(
        "position", "doc_id", "category", "text"
    )


# --- vectors and search ---------------------------------------------------


@register
def vector_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The collection written and read back: position and length of every vector."""
    path = fresh_path(spark, "collection")
    embedded = documents_with_vectors(spark, sf_dir).withColumn("doc_seq", F.col("doc_id"))
    tables.write_collection(embedded, path)
    read = tables.read_vectors(spark, path)
    return read.select(
        "doc_id", "category", "doc_index", F.round(vc.l2_norm(F.col("embedding")), 4).alias("norm")
    )


@register
def collection_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").agg(F.count("*").alias("n"))


@register
def hashed_embed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashed unit vectors of all documents and turns."""
    docs = documents(spark, sf_dir).select(
        F.concat(F.lit("d"), F.col("doc_id")).alias("id"), "text"
    )
    turns = table(spark, sf_dir, "conversations").select(
        F.concat_ws("-", F.lit("c"), "conv_id", "turn").alias("id"), "text"
    )
    embedded = encode.embed(docs.unionByName(turns))
    return embedded.select(
        "id",
        F.size(F.filter("embedding", lambda x: x != 0)).alias("terms"),
        F.round(vc.l2_norm(F.col("embedding")), 4).alias("norm"),
    )


@register
def weighted_embed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and turns under term weights that were fitted on the documents and stored."""
    docs = documents(spark, sf_dir).select(F.concat(F.lit("d"), F.col("doc_id")).alias("id"), "text")
    path = fresh_path(spark, "terms")
    term_model.save(spark, term_model.fit(docs), path)
    turns = table(spark, sf_dir, "conversations").select(F.concat_ws("-", F.lit("c"), "conv_id", "turn").alias("id"), "text")
    embedded = term_model.embed(docs.unionByName(turns), term_model.load(spark, path))
    cells = embedded.select("id", F.posexplode("embedding").alias("bucket", "weight")).filter("weight <> 0")
    return cells.select("id", "bucket", F.round("weight", 6).alias("weight"))


@register
def l2_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors stretched by a factor (zero for some), brought back to unit length."""
    stretched = F.transform(
        vc.as_doubles(F.col("embedding")), lambda x: x * (F.col("vec_id") % 7)
    )
    rows = table(spark, sf_dir, "embeddings").select("vec_id", stretched.alias("embedding"))
    unit = rows.select("vec_id", F.posexplode(vc.l2_normalize(F.col("embedding"))).alias("pos", "value"))
    return unit.select("vec_id", "pos", F.round("value", 6).alias("value"))


@register
def cosine_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cosine of every vector with the centre of its label."""
    mean = label_centres(spark, sf_dir).select(
        F.col("cluster").alias("label"), vc.l2_normalize(F.col("centre")).alias("centre")
    )
    rows = table(spark, sf_dir, "embeddings").join(mean, "label")
    return rows.select("vec_id", F.round(vc.dot(F.col("embedding"), F.col("centre")), 4).alias("cosine"))


def _self_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("seq"), F.col("embedding").alias("vector")
    )


@register
def knn_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact nearest vectors of every vector."""
    found = search.nearest_documents(
        table(spark, sf_dir, "embeddings"), _self_queries(spark, sf_dir), TOP_N, doc_id="vec_id"
    )
    return found.select("seq", "doc_id", "id", F.round("score", 4).alias("similarity"))


@register
def knn_blocked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same search by the block join that serves two large sides."""
    found = search.nearest_documents(
        table(spark, sf_dir, "embeddings"),
        _self_queries(spark, sf_dir),
        TOP_N,
        doc_id="vec_id",
        travel_rows=0,
        block_rows=400,
    )
    return found.select("seq", "doc_id", "id", F.round("score", 4).alias("similarity"))


@register
def knn_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search only in the clusters nearest to the query."""
    middle = centres(spark, sf_dir)
    docs = cache.assign_clusters(table(spark, sf_dir, "embeddings"), middle, "embedding")
    found = search.nearest_documents_pruned(
        docs, _self_queries(spark, sf_dir), middle, NPROBE, TOP_N, doc_id="vec_id"
    )
    return found.select("seq", "doc_id", "id", F.round("score", 4).alias("similarity"))


@register
def knn_certified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact search over a collection partitioned by cluster, which skips what no bound lets in."""
    found, _ = certified(spark, sf_dir)
    return found.select("seq", "doc_id", "id", F.round("score", 4).alias("similarity"))


def certified(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    middle = centres(spark, sf_dir)
    rows = cache.assign_clusters(table(spark, sf_dir, "embeddings"), middle, "embedding")
    rows = rows.select(F.col("vec_id").alias("doc_id"), "embedding", "dominant_cluster")
    docs = materialise(rows, "clusters", ["dominant_cluster"])
    return search.nearest_documents_certified(docs, _self_queries(spark, sf_dir), middle, TOP_N)


@register
def knn_result_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits with category and text, one row per query."""
    docs = documents_with_vectors(spark, sf_dir)
    found = search.nearest_documents(docs, _self_queries(spark, sf_dir), TOP_N)
    lists = search.hit_lists(search.search_hits(found, docs))
    return lists.select("seq", flat_hits(F.col("result")).alias("hits"))


# --- build ----------------------------------------------------------------


@register
def build_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The offline build over all documents, then once more reusing its tables.

    Five clusters are fitted, the bounds ask for four, so the model is fitted again.
    """
    root = fresh_path(spark, "build")
    run_build(spark, raw_articles(spark, sf_dir), root, cluster_counts=(5,), bounds=(4, 4), fuzziness=1.1)
    build = run_build(spark, None, root, reuse=True)
    memberships, _ = tables.load_clusters(spark, build.clusters)
    sizes = memberships.select("doc_id", F.size("memberships").alias("n_clusters"))
    return tables.read_vectors(spark, build.collection).select("doc_id", "category", "doc_index").join(sizes, "doc_id")


@register
def build_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which stages four runs of a build compute: anew, unchanged, with longer signatures, with other options."""
    root, raw = fresh_path(spark, "build"), raw_articles(spark, sf_dir)
    longer = raw.withColumn("text", F.concat("text", F.lit("\n--\nmore")))
    runs = []
    for number, (rows, fuzziness) in enumerate([(raw, 1.1), (raw, 1.1), (longer, 1.1), (longer, 1.2)], 1):
        build = run_build(spark, rows, root, reuse=True, cluster_counts=(4,), bounds=(4, 4), fuzziness=fuzziness)
        memberships, _ = tables.load_clusters(spark, build.clusters)
        # Written: the next run replaces the tables that this one counts.
        counted = materialise(memberships.agg(F.count("*").alias("n_docs")), "build-count")
        for stage in ("index", "cluster"):
            ran = F.lit(stage in build.ran).alias("ran")
            runs.append(counted.select(F.lit(number).alias("run"), F.lit(stage).alias("stage"), ran, "n_docs"))
    return functools.reduce(DataFrame.unionByName, runs)


# --- clusters -------------------------------------------------------------


@register
def fuzzy_memberships(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = memberships(spark, sf_dir)
    long = rows.select("doc_id", F.posexplode_outer("memberships").alias("cluster", "u"))
    return long.select("doc_id", "cluster", F.round("u", 6).alias("membership"))


@register
def dominant_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = mb.hard_label(F.col("memberships"))
    return memberships(spark, sf_dir).select("doc_id", label.alias("dominant_cluster"))


@register
def membership_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    entropy = F.round(mb.entropy(F.col("memberships")), 6)
    return memberships(spark, sf_dir).select("doc_id", entropy.alias("entropy"))


@register
def cluster_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    quality = cluster_report.cluster_quality(memberships(spark, sf_dir))
    return quality.select("n_docs", "n_labels", F.round("fpc", 6).alias("fpc"))


@register
def top_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = cluster_report.top_docs_per_cluster(memberships(spark, sf_dir))
    return top.withColumn("membership", F.round("membership", 6))


@register
def boundary_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    edge = cluster_report.boundary_documents(memberships(spark, sf_dir))
    long = edge.select("doc_id", "category", "entropy", F.explode("memberships").alias("cluster", "u"))
    return long.select(
        "doc_id", "category", F.round("entropy", 6).alias("entropy"), "cluster",
        F.round("u", 6).alias("membership"),
    )


@register
def boundary_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    edge = cluster_report.boundary_documents(memberships(spark, sf_dir))
    shown = cluster_report.boundary_report(edge)
    return shown.withColumn("membership", F.round("membership", 3))


@register
def silhouette_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(F.lit(10).alias("k"), "label", "embedding")
    return silhouette.silhouettes(rows).select("k", F.round("silhouette", 6).alias("silhouette"))


def _coarser_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelings with 1 to 12 clusters, made by folding the label."""
    k = F.explode(F.sequence(F.lit(1), F.lit(12))).alias("k")
    rows = table(spark, sf_dir, "embeddings").select("label", "embedding", k)
    return rows.select("k", (F.col("label") % F.col("k")).alias("label"), "embedding")


@register
def silhouette_by_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = silhouette.silhouettes(_coarser_labels(spark, sf_dir))
    return scores.select("k", F.round("silhouette", 6).alias("silhouette"))


@register
def select_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = silhouette.silhouettes(_coarser_labels(spark, sf_dir)).select(
        "k", F.round("silhouette", 6).alias("silhouette")
    )
    return model.select_k(scores, (5, 8))


@register
def fcm_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One update of the centres, starting from the label means."""
    points = model.fit_points(table(spark, sf_dir, "embeddings"), None, "vec_id")
    start = centres(spark, sf_dir)
    k, dim = start.shape
    sums = fcm.fit_pass(points, [(k, start, start)], mb.FUZZINESS)
    weight = F.slice("sums", k * dim + 1, k)
    cells = sums.select("sums", weight.alias("weight"), F.posexplode("sums").alias("at", "total"))
    cells = cells.filter(F.col("at") < k * dim)
    cluster = F.floor(F.col("at") / dim).cast("int")
    return cells.select(
        cluster.alias("cluster"),
        (F.col("at") % dim).alias("pos"),
        F.round(F.col("total") / F.get("weight", cluster), 6).alias("value"),
    )


@register
def fcm_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit ten clusters from the random start; the fit's own figures."""
    points = model.fit_points(table(spark, sf_dir, "embeddings"), key="vec_id")
    fit = fcm.fit_fuzzy(points, [10])[10]
    table_of = fcm.centres_table(spark, fit.centres)
    return spark.createDataFrame(
        [(fit.k, round(fit.fpc, 4), fit.passes, fit.converged, fit.collapsed)],
        "k int, fpc double, passes int, converged boolean, collapsed boolean",
    ).select("*", table_of.agg(F.count("*")).scalar().alias("n_centres"))


@register
def k_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All k from 5 to 25 over shared passes, with the scores of their hard labels."""
    points = model.fit_points(table(spark, sf_dir, "embeddings"), key="vec_id")
    return model.sweep_k(points).scores


@register
def sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample of a hundred vectors: sampling is the operator."""
    return fcm.sample_rows(table(spark, sf_dir, "embeddings"), SAMPLED, "vec_id").select("vec_id")


@register
def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample of a hundred documents in which every source and language has its share."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.concat_ws("/", "source", "lang").alias("stratum"))
    return fcm.stratified_rows(docs, "stratum", SAMPLED).select("doc_id", "stratum")


@register
def cluster_artifact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Memberships and centres saved and loaded; the centres, cell by cell."""
    path = fresh_path(spark, "clusters")
    tables.save_clusters(memberships(spark, sf_dir), label_centres(spark, sf_dir), path)
    stored, middle = tables.load_clusters(spark, path)
    cells = middle.select("cluster", F.posexplode("centre").alias("pos", "value"))
    docs = stored.agg(F.count("*")).scalar().alias("n_docs")
    return cells.select("cluster", "pos", F.round("value", 6).alias("value"), docs)


@register
def cluster_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary document saved as JSON and loaded, flattened to text."""
    path = fresh_path(spark, "summary")
    rows = materialise(memberships(spark, sf_dir), "memberships")
    scores = silhouette.silhouettes(_coarser_labels(spark, sf_dir))
    tables.save_summary(cluster_report.summary(rows, scores, 10), path)
    stored = tables.load_summary(spark, path)
    first = F.transform(
        F.sequence(F.lit(0), F.lit(9)),
        lambda c: F.array_join(
            F.transform(F.col("top_docs_per_cluster")[c.cast("string")], lambda d: d["doc_id"]), ","
        ),
    )
    return stored.select(
        "n_clusters",
        "n_docs",
        "fuzziness_m",
        F.size("silhouette_scores").alias("n_scores"),
        F.array_join(first, "|").alias("top_docs"),
        F.array_join(F.transform("boundary_documents", lambda d: d["doc_id"]), ",").alias("boundary"),
    )


# --- cache ----------------------------------------------------------------


def _found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cache.lookup(cached_entries(spark, sf_dir), cache_queries(spark, sf_dir), CACHE_THRESHOLD)


@register
def cluster_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dominant cluster of every query and its membership there."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.reverse("embedding").alias("vector"))
    assigned = cache.assign_clusters(rows, centres(spark, sf_dir))
    return assigned.select(
        "vec_id", "dominant_cluster", F.round(F.array_max("membership_vector"), 6).alias("membership")
    )


@register
def cache_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _found(spark, sf_dir).select(
        "seq", "dominant_cluster", "entry_seq", F.round("score", 4).alias("score"), "cache_hit"
    )


@register
def cache_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers of the hits, taken from the cache."""
    answers = cache.lookup_answers(_found(spark, sf_dir), cached_entries(spark, sf_dir))
    return answers.select(
        "seq", "matched_query", "similarity_score", flat_hits(F.col("result")).alias("hits")
    )


@register
def cache_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = cache.count_outcomes(_found(spark, sf_dir))
    texts = cached_entries(spark, sf_dir).agg(F.count_distinct("query"))
    return cache.with_rate(
        counted.select("*", texts.scalar().alias("total_entries")), CACHE_THRESHOLD
    )


@register
def cache_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot and a later save of its counters, loaded again."""
    path = fresh_path(spark, "cache")
    state = cache.CacheState(cached_entries(spark, sf_dir), 3, 7, CACHE_THRESHOLD)
    cache_store.save_snapshot(spark, state, path)
    cache_store.save_counters(spark, state.record(hits=2, misses=1), path)
    return cache_store.load_snapshot(spark, path, threshold=0.9).stats()


def _replay(spark: SparkSession, sf_dir: str, flushes: bool = False) -> replay.Replay:
    return replay.replay_log(
        query_log(spark, sf_dir, flushes), centres(spark, sf_dir), threshold=REPLAY_THRESHOLD
    )


@register
def cache_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hit or miss of every query of the log, played in order."""
    return _replay(spark, sf_dir).decisions.select(
        "seq", "dominant_cluster", "cache_hit", "source_seq"
    )


def repeated_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flushed log, in which half of the rows repeat an earlier one's text and vector, with thresholds of their own."""
    rows = query_log(spark, sf_dir, flushes=True).drop("threshold")
    earlier = rows.select(F.col("seq").alias("_of"), *[F.col(c).alias(f"_{c}") for c in ("query", "vector")])
    vectors_of = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("_of"), F.col("embedding").alias("_vector"))
    earlier = earlier.drop("_vector").join(vectors_of, "_of").withColumn("_query", F.concat(F.lit("query "), "_of"))
    rows = rows.withColumn("_of", F.when(F.col("seq") % 2 == 1, F.floor(F.col("seq") / 4)).otherwise(F.col("seq")))
    own = F.when(F.col("seq") % 5 == 0, F.lit(LOOSE_THRESHOLD)).when(F.col("seq") % 5 == 1, F.lit(1.0))
    played = F.col("op") == "query"
    return rows.join(earlier, "_of", "left").select(
        "seq",
        "op",
        F.when(played, F.coalesce("_query", "query")).alias("query"),
        F.when(played, F.coalesce("_vector", "vector")).alias("vector"),
        own.alias("threshold"),
        "n_results",
    )


@register
def cache_replay_chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log of repeated texts, own thresholds and flushes in chunks: earlier chunks' entries answer later ones."""
    played = replay.replay_log(
        repeated_log(spark, sf_dir), centres(spark, sf_dir), threshold=REPLAY_THRESHOLD, chunk_rows=256
    )
    return played.decisions.select("seq", "era", "dominant_cluster", "cache_hit", "entry_seq", "source_seq")


@register
def cache_replay_flushed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same log with flushes in it."""
    return _replay(spark, sf_dir, True).decisions.select(
        "seq", "era", "dominant_cluster", "cache_hit", "source_seq"
    )


@register
def replay_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.replay_stats(_replay(spark, sf_dir, True))


@register
def replay_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full answers: a search on a miss, the cached result on a hit."""
    played = _replay(spark, sf_dir)
    docs = documents_with_vectors(spark, sf_dir)
    answers = replay.responses(played, replay.search_misses(played, docs))
    return answers.select(
        "seq", "query", "cache_hit", "matched_query", "similarity_score", "dominant_cluster",
        flat_hits(F.col("result")).alias("hits"),
    )


@register
def cache_inserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries after the flushed log was played on top of a fixed cache.

    The fixed cache holds the reversed vectors, numbered below the log.
    """
    middle = centres(spark, sf_dir)
    rows = table(spark, sf_dir, "embeddings").select(
        (F.col("vec_id") - 1_000_000).alias("seq"),
        F.concat(F.lit("old "), F.col("vec_id")).alias("query"),
        F.reverse("embedding").alias("vector"),
        F.lit(None).cast(cache.HIT_TYPE).alias("result"),
    )
    entries = materialise(cache.assign_clusters(rows, middle), "cache-entries")
    names = ["seq", "query", "vector", "result", "dominant_cluster", "membership_vector"]
    state = cache.CacheState(entries.select(*names), threshold=CACHE_THRESHOLD)
    played = replay.replay_log(query_log(spark, sf_dir), middle, state=state)
    none = played.decisions.select("seq", F.lit(None).cast(cache.HIT_TYPE).alias("result")).limit(0)
    after = replay.state_after(played, none, middle, state)
    return after.entries.select("seq", "query", "dominant_cluster")


@register
def text_query_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns as text queries: embedded, replayed, answered from the documents."""
    embedded = encode.embed(
        corpus.clean_and_keep_long(
            documents(spark, sf_dir).select("doc_id", F.col("source").alias("category"), "text")
        )
    )
    docs = materialise(embedded, "documents", compression="zstd")
    turns = table(spark, sf_dir, "conversations").filter("role = 'user'").select(
        "conv_id", "turn", F.col("text").alias("query")
    )
    turns = ordering.with_dense_index(turns, ["conv_id", "turn", "query"], "seq").drop("conv_id", "turn")
    log = encode.embed(turns, text="query").select(
        "seq", F.lit("query").alias("op"), "query", F.col("embedding").alias("vector"),
        F.lit(None).cast("double").alias("threshold"), F.lit(None).cast("int").alias("n_results"),
    )
    middle = docs.groupBy("category").agg(vc.mean_vector(F.col("embedding")).alias("centre"))
    ranked = ordering.with_dense_index(middle, "category", "n")
    points = mb.collect_centres(ranked.select(F.col("n").cast("int").alias("cluster"), "centre"))
    played = replay.replay_log(log, points, threshold=0.6)
    answers = replay.responses(played, replay.search_misses(played, docs))
    return answers.select(
        "seq", "cache_hit", "similarity_score", "dominant_cluster",
        F.size("result").alias("n_hits"),
    )


def _log_files(rows: DataFrame, least: int) -> list[DataFrame]:
    """A log in order of ``seq``, cut into at least ``least`` parts of a file each, so that no file grows with the log."""
    files = max(least, -(-rows.count() // LOG_FILE_ROWS))
    ranges = rows.repartitionByRange(files, "seq").withColumn("part", F.spark_partition_id())
    stored = materialise(ranges, "log-ranges", ["part"])
    return [stored.filter(F.col("part") == i).drop("part").coalesce(1) for i in range(files)]


@register
def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flushed log as a stream of four files or more, one per micro-batch; entries are merged after every second."""
    path = fresh_path(spark, "stream-log")
    for part in _log_files(query_log(spark, sf_dir, flushes=True), 4):
        part.write.mode("append").parquet(path)
    log = spark.readStream.schema(part.schema).option("maxFilesPerTrigger", 1).parquet(path)
    # Every batch reads them several times: joined once, not once per read.
    docs = materialise(documents_with_vectors(spark, sf_dir), "stream-documents")
    stream = QueryStream(
        spark, fresh_path(spark, "stream"), centres(spark, sf_dir), docs, REPLAY_THRESHOLD, fanout=2
    )
    running = stream.start(log, fresh_path(spark, "stream-progress")).trigger(availableNow=True).start()
    running.awaitTermination()
    return stream.responses().select(
        "seq", "query", "cache_hit", "matched_query", "similarity_score", "dominant_cluster",
        flat_hits(F.col("result")).alias("hits"),
    )


@register
def stream_replay_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flushed log as a stream of eight files or more through keyed state, with a restart after half of them."""
    source, root = fresh_path(spark, "keyed-log"), fresh_path(spark, "keyed-stream")
    middle = centres(spark, sf_dir)
    parts = _log_files(query_log(spark, sf_dir, flushes=True), 8)
    for number, part in enumerate(parts, 1):
        part.write.mode("append").parquet(source)
        if number in (len(parts) // 2, len(parts)):
            log = spark.readStream.schema(part.schema).option("maxFilesPerTrigger", 1).parquet(source)
            played = keyed_stream.keyed_decisions(log, middle, REPLAY_THRESHOLD)
            writer = played.writeStream.format("parquet").option("path", f"{root}/decisions")
            writer.option("checkpointLocation", f"{root}/progress").trigger(availableNow=True).start().awaitTermination()
    decisions = spark.read.schema(keyed_stream.DECISIONS).parquet(f"{root}/decisions")
    return decisions.select("seq", "era", "dominant_cluster", "cache_hit", "source_seq")


@register
def validate_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid and rejected requests, with the reason."""
    turns = table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        F.when(F.col("turn") == 2, "").otherwise(F.col("text")).alias("query"),
        F.when(F.col("role") == "user", F.col("turn") * 0.3 - 0.1).alias("threshold"),
        F.when(F.col("conv_id") % 3 != 0, F.col("conv_id") % 24).cast("int").alias("n_results"),
    )
    valid, rejected = requests.split_requests(turns)
    both = valid.withColumn("reason", F.lit(None).cast("string")).unionByName(rejected)
    return both.select("conv_id", "turn", "n_results", "reason")


@register
def health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cache.health(
        table(spark, sf_dir, "documents"), label_centres(spark, sf_dir), cached_entries(spark, sf_dir)
    )


# --- thresholds -----------------------------------------------------------


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base query: the first one logged."""
    return query_log(spark, sf_dir).orderBy("seq").limit(1)


@register
def similarity_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similarity of every query to the base query."""
    report = thresholds.similarity_to(_base(spark, sf_dir), query_log(spark, sf_dir))
    return report.select("seq", "query", "similarity")


@register
def case_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for labelled cases."""
    cases = table(spark, sf_dir, "embeddings").select(
        F.concat(F.lit("case "), F.col("label")).alias("label"),
        F.col("vec_id").alias("seq"),
        F.reverse("embedding").alias("vector"),
    )
    return thresholds.similarity_to(_base(spark, sf_dir), cases).select("label", "seq", "similarity")


@register
def base_query_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HIT or MISS at every threshold with only the base query cached."""
    middle = centres(spark, sf_dir)
    entry = cache.assign_clusters(_base(spark, sf_dir), middle)
    tests = cache.assign_clusters(query_log(spark, sf_dir), middle)
    swept = thresholds.threshold_sweep(entry, tests, SWEEP_THRESHOLDS)
    return swept.select("seq", "threshold", "outcome")


@register
def threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HIT or MISS at every threshold against the whole fixed cache."""
    swept = thresholds.threshold_sweep(
        cached_entries(spark, sf_dir), cache_queries(spark, sf_dir), SWEEP_THRESHOLDS
    )
    return swept.select("seq", "threshold", "outcome")
