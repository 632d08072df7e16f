"""The offline build: articles to collection, collection to clusters."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from corpuscle.functions.membership import FUZZINESS
from corpuscle.operators import fcm
from corpuscle.operators.cluster_report import predict_memberships, summary
from corpuscle.operators.corpus import SMOKE_DOCS, first_documents, usable_corpus
from corpuscle.operators.encode import Encoder, embed
from corpuscle.operators.model import choose_model, fit_points, model_centres, sweep_k
from corpuscle.sources.manifest import Manifest, content_digest
from corpuscle.sources.shared import materialise
from corpuscle.sources.tables import (
    open_collection,
    read_vectors,
    save_clusters,
    save_summary,
    table_exists,
    write_collection,
)


@dataclass(frozen=True)
class Build:
    """Where the tables of one build are, and which stages its last run computed."""

    spark: SparkSession
    root: str
    ran: tuple[str, ...] = ()

    @property
    def collection(self) -> str:
        return f"{self.root}/collection"

    @property
    def clusters(self) -> str:
        return f"{self.root}/clusters"

    @property
    def summary(self) -> str:
        return f"{self.root}/summary"

    def index(
        self,
        raw: DataFrame,
        load_encoder: Callable[[], Encoder] | None = None,
        smoke: bool = False,
    ) -> None:
        """Clean, filter, de-duplicate and embed ``raw``; write the collection."""
        corpus = usable_corpus(raw)
        if smoke:
            corpus = first_documents(corpus)
        # Written once: numbering and embedding both read it.
        corpus = materialise(corpus, "corpus")
        write_collection(embed(corpus, load_encoder), self.collection)

    def cluster(
        self,
        cluster_counts: Sequence[int] = fcm.CLUSTER_COUNTS,
        bounds: tuple[int, int] = fcm.CLUSTER_BOUNDS,
        fuzziness: float = FUZZINESS,
        sample_size: int | None = None,
        sample_strata: str | None = None,
        smoke: bool = False,
    ) -> None:
        """Sweep k on all vectors or a sample (by ``category``, say, if it is to have strata), refit, predict all memberships; write artifact and summary."""
        vectors = read_vectors(self.spark, self.collection)
        if smoke:
            vectors = vectors.orderBy("doc_index").limit(SMOKE_DOCS)
        sweep = sweep_k(fit_points(vectors, sample_size, strata=sample_strata), cluster_counts, fuzziness=fuzziness)
        model = choose_model(sweep, bounds)
        sweep.points.unpersist()
        save_clusters(
            predict_memberships(vectors, model.centres, fuzziness),
            model_centres(self.spark, model),
            self.clusters,
        )
        stored = self.spark.read.parquet(f"{self.clusters}/memberships")
        save_summary(summary(stored, model.scores, model.k, fuzziness), self.summary)


def run_build(
    spark: SparkSession,
    raw: DataFrame | None,
    root: str,
    *,
    skip_embedding: bool = False,
    skip_clustering: bool = False,
    reuse: bool = False,
    smoke: bool = False,
    load_encoder: Callable[[], Encoder] | None = None,
    encoder_name: str | None = None,
    **cluster_options,
) -> Build:
    """Run the stages in order.

    With ``reuse`` a stage is skipped if it ended on the same input with the
    same parameters, as its manifest says. The input of the first stage is the
    content of ``raw`` (without ``raw``: the collection as it is), that of the
    second the stored vectors: a change of ``raw`` that cleaning takes away
    leaves the clusters as they are. Options of clustering that aren't given are
    those of the stored clusters. ``encoder_name`` stands for the encoder and
    its version; it is its function's name unless given.
    """
    build = Build(spark, root)
    if not skip_embedding and not (reuse and raw is None and table_exists(spark, build.collection)):
        if raw is None:
            raise ValueError("there is no collection yet and nothing to build it from")
        named = encoder_name or (f"{load_encoder.__module__}.{load_encoder.__qualname__}" if load_encoder else "hashed")
        build = _stage(build, "index", raw, {"smoke": smoke, "encoder": named}, reuse, lambda: build.index(raw, load_encoder, smoke))
    if not skip_clustering:
        options = {**cluster_options, "smoke": smoke}
        if reuse:
            options = {**Manifest(spark, root, "cluster").parameters, **options}
        vectors = open_collection(spark, build.collection).select("doc_id", "metadata", "embedding")
        build = _stage(build, "cluster", vectors, options, reuse, lambda: build.cluster(**options))
    return build


def _stage(
    build: Build, name: str, rows: DataFrame, parameters: dict[str, Any], reuse: bool, compute: Callable[[], None]
) -> Build:
    manifest = Manifest(build.spark, build.root, name)
    digest = content_digest(rows)
    if reuse and manifest.matches(digest, parameters):
        return build
    manifest.begin()
    compute()
    manifest.end(digest, parameters)
    return replace(build, ran=(*build.ran, name))
