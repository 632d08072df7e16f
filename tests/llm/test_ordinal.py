"""Ordinal regression: recovered thresholds, held-out grades, rows of all kinds."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from corpuscle.llm import hashing, ordinal
from corpuscle.llm.labelled import held_out


def test_gradient_and_order():
    rng = np.random.default_rng(1)
    n = 3000
    buckets = rng.integers(0, 5, size=n)
    weights = np.array([-3.0, -1.0, 0.0, 1.0, 3.0])
    latent = weights[buckets] + rng.logistic(size=n)
    grades = np.digitize(latent, [-1.5, 0.5, 2.0])
    model = ordinal.fit_rows(np.arange(n), buckets, np.ones(n), grades, 4)
    assert model.grades == 4 and (np.diff(model.thresholds) > 0).all()
    centred = model.thresholds - model.weights[2]
    assert np.abs(centred - [-1.5, 0.5, 2.0]).max() < 0.35
    assert np.abs(model.weights[:5] - model.weights[2] - weights).max() < 0.5


def test_latent_is_the_sum_of_features():
    texts = pa.array(["One two, THREE!!", None, "", "x%%% y%%% x%%%", "a " * 50])
    model = ordinal.Model(np.random.default_rng(2).normal(size=ordinal.BUCKETS), np.array([0.0]))
    whole = ordinal.latent(texts, model)
    for i in range(len(texts)):
        assert np.isclose(ordinal.latent(texts.slice(i, 1), model)[0], whole[i])
    (part,) = hashing.slices(texts.slice(3, 1))
    owner, bucket, value = ordinal.features(part)
    assert np.isclose((value * model.weights[bucket]).sum(), whole[3]) and np.isclose(value.sum(), 4.0)


def _corpus(n):
    rng = random.Random(3)
    word = lambda: "".join(rng.choices(["ka", "lo", "mi", "ter", "é"], k=rng.randint(1, 4)))
    rows, ratings = [], []
    for i in range(n):
        grade = rng.choice([0, 1, 2])
        words = [word() for _ in range(rng.choice([8, 40, 200]))]
        share = (0.9, 0.4, 0.0)[grade]
        rows.append((i, " ".join(w + "%%%" if rng.random() < share else w for w in words)))
        ratings.append((i, grade))
    return rows, ratings


def test_held_out_grades(spark):
    rows, ratings = _corpus(2500)
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, keep int").repartition(4)
    model = ordinal.fit(docs, spark.createDataFrame(ratings, "doc_id bigint, rating int"), F.col("rating"), 3)
    got = ordinal.score(docs, model).withColumn("h", held_out()).collect()
    truth = dict(ratings)
    unseen = [r for r in got if r["h"]]
    assert np.mean([round(r["expected_grade"]) == truth[r["doc_id"]] for r in unseen]) > 0.85
    assert np.mean([r["keep"] == (truth[r["doc_id"]] >= 1) for r in unseen]) > 0.9
    kept = {r["doc_id"] for r in ordinal.keep_good(docs, model).collect()}
    assert kept == {r["doc_id"] for r in got if r["keep"]}


def test_odd_rows_and_no_ratings(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "a b"), (3, "w " * 30_000), (3, "w " * 30_000)], "doc_id bigint, text string")
    for rows in ([], [(1, 0), (None, 1), (2, None), (3, 9), (3, 1)]):
        ratings = spark.createDataFrame(rows, "doc_id bigint, rating int")
        model = ordinal.fit(docs, ratings, F.col("rating"), 3)
        got = ordinal.score(docs, model).collect()
        assert len(got) == 5 and all(0 <= r["tail"] <= 1 and 0 <= r["expected_grade"] <= 2 for r in got)
        assert len({(r["tail"]) for r in got if r["doc_id"] == 3}) == 1
        if not rows:
            assert all(r["keep"] for r in got)
    assert ordinal.score(docs.limit(0), model).count() == 0
