import hashlib

import numpy as np
import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from corpuscle.functions import membership as mb
from corpuscle.operators import cluster_report, fcm, model, silhouette

from support import unit_rows, vector_rows


def _blobs(k=4, per=30, dim=3, seed=2):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(k, dim)) * 6
    return np.vstack([m + rng.normal(size=(per, dim)) * 0.3 for m in middle]), middle


def _membership(x, centres, m=2.0):
    d = np.linalg.norm(x[:, None] - centres[None], axis=2)
    w = np.maximum(d, np.finfo(float).eps) ** (-2 / (m - 1))
    return w / w.sum(axis=1, keepdims=True)


def _numpy_fit(x, u, m, tolerance, passes):
    for done in range(1, passes + 1):
        w = u**m
        centres = (w.T @ x) / w.sum(axis=0)[:, None]
        new = _membership(x, centres, m)
        moved, u = np.linalg.norm(new - u), new
        if moved < tolerance:
            break
    return centres, (u**2).sum() / len(x), done


@pytest.mark.parametrize("m", [2.0, 1.5])
def test_memberships_closed_form(spark, m):
    x = unit_rows(50, 1)
    centres = unit_rows(5, 2)
    x[0] = centres[3]
    df = vector_rows(spark, x).withColumn("u", mb.memberships(centres, m)("embedding"))
    got = np.array([r["u"] for r in df.orderBy("vec_id").collect()])
    assert np.allclose(got, _membership(x, centres, m), atol=1e-9)
    assert np.allclose(got.sum(axis=1), 1.0)
    assert got[0].argmax() == 3 and got[0].max() > 0.999


def test_measures_of_a_membership(spark):
    rng = np.random.default_rng(1)
    u = rng.dirichlet(np.ones(4), size=100)
    u[0] = [0.5, 0.5, 0.0, 0.0]
    df = spark.createDataFrame(
        [(f"cat/doc{i}", "c", [float(v) for v in row]) for i, row in enumerate(u)],
        "doc_id string, category string, memberships array<double>",
    )
    rows = df.select(
        "doc_id", mb.hard_label(F.col("memberships")).alias("l"), mb.entropy(F.col("memberships")).alias("e")
    ).collect()
    clipped = np.clip(u, 1e-10, 1)
    expected = -(clipped * np.log(clipped)).sum(axis=1)
    assert [r["l"] for r in rows] == u.argmax(axis=1).tolist()  # first on ties
    assert [r["e"] for r in rows] == pytest.approx(expected.tolist())

    quality = cluster_report.cluster_quality(df).first()
    assert quality["n_docs"] == 100 and quality["n_labels"] == 4
    assert quality["fpc"] == pytest.approx((u**2).sum() / 100)

    top = cluster_report.top_docs_per_cluster(df, 3).orderBy("cluster", "rank").collect()
    for c in range(4):
        best = np.argsort(-u[:, c], kind="stable")[:3]
        assert [r["doc_id"] for r in top if r["cluster"] == c] == [f"cat/doc{i}" for i in best]

    edge = cluster_report.boundary_documents(df, 5, 2).orderBy(F.desc("entropy")).collect()
    assert [r["doc_id"] for r in edge] == [f"cat/doc{i}" for i in np.argsort(-expected)[:5]]
    first = edge[0]["memberships"]
    assert len(first) == 2 and max(first.values()) == pytest.approx(u[int(edge[0]["doc_id"][7:])].max())


def _points(spark, x):
    return vector_rows(spark, x).select(
        F.col("embedding").cast("array<double>").alias("embedding"), fcm.start_key("vec_id").alias("start_key")
    )


def test_fit_equals_plain_numpy_loop(spark):
    x, _ = _blobs()
    x = x.astype(np.float32).astype(np.float64)
    points = _points(spark, x).repartition(3).cache()
    order = points.toPandas()
    data, keys = np.stack(order["embedding"].to_numpy()), order["start_key"].to_numpy()
    fits = fcm.fit_fuzzy(points, [3, 4], tolerance=1e-5, max_passes=60)
    for k, fit in fits.items():
        centres, fpc, passes = _numpy_fit(data, fcm._start_memberships(keys, k), 2.0, 1e-5, 60)
        assert fit.passes == passes
        assert np.allclose(fit.centres, centres, atol=1e-6)
        assert fit.fpc == pytest.approx(fpc, abs=1e-6)
        assert not fit.collapsed


def test_fit_does_not_depend_on_partitioning(spark):
    x, _ = _blobs(3, 20)
    one = fcm.fit_fuzzy(_points(spark, x).coalesce(1), [3])[3]
    many = fcm.fit_fuzzy(_points(spark, x).repartition(6), [3])[3]
    assert one.passes == many.passes and np.allclose(one.centres, many.centres, atol=1e-8)


def test_fit_stops_after_max_passes(spark):
    x, _ = _blobs(3, 20)
    fit = fcm.fit_fuzzy(_points(spark, x), [3], tolerance=0.0, max_passes=4)[3]
    assert fit.passes == 4 and not fit.converged


def test_high_dimension_collapses_and_says_so(spark):
    fit = fcm.fit_fuzzy(_points(spark, unit_rows(200, 8, 64)), [6])[6]
    assert fit.collapsed and fit.fpc == pytest.approx(1 / 6, rel=1e-3)


def test_silhouette_is_the_evaluators(spark):
    x = unit_rows(90, 3)
    df = vector_rows(spark, x).withColumn("label", (F.col("vec_id") % 4).cast("int"))
    ours = silhouette.silhouettes(df.withColumn("k", F.lit(4))).first()["silhouette"]
    theirs = ClusteringEvaluator(
        featuresCol="f", predictionCol="label", distanceMeasure="cosine"
    ).evaluate(df.withColumn("f", array_to_vector("embedding")))
    assert ours == pytest.approx(theirs, abs=1e-9)


def test_labelings_without_a_silhouette(spark):
    x = vector_rows(spark, unit_rows(6, 3))
    same = x.select(F.lit(1).alias("k"), F.lit(0).alias("label"), "embedding")
    own = x.select(F.lit(6).alias("k"), F.col("vec_id").cast("int").alias("label"), "embedding")
    got = {r["k"]: r["silhouette"] for r in silhouette.silhouettes(same.unionByName(own)).collect()}
    assert got == {1: -1.0, 6: -1.0}


@pytest.mark.parametrize(
    "scores, expected",
    [
        ([(5, 0.1), (12, 0.4), (13, 0.4)], (12, 12)),
        ([(5, 0.9), (12, 0.4)], (5, 10)),
        ([(25, 0.9), (12, 0.4)], (25, 20)),
        ([(5, -1.0), (6, -1.0)], None),
    ],
)
def test_choice_of_k(spark, scores, expected):
    row = model.select_k(spark.createDataFrame(scores, "k int, silhouette double")).first()
    assert (None if row is None else (row["best_k"], row["selected_k"])) == expected


def test_sweep_finds_the_blobs_and_refits_outside_the_bounds(spark):
    x, _ = _blobs(4, 25)
    points = model.fit_points(vector_rows(spark, x), None, "vec_id")
    sweep = model.sweep_k(points, [3, 4])
    inside = model.choose_model(sweep, (2, 8))
    assert inside.k in (3, 4) and len(inside.centres) == inside.k
    outside = model.choose_model(sweep, (5, 8))
    assert outside.k == 5 and len(outside.centres) == 5


def test_no_usable_k_is_an_error(spark):
    same = np.tile(unit_rows(1, 4), (30, 1))
    points = model.fit_points(vector_rows(spark, same), None, "vec_id")
    with pytest.raises(ValueError, match="no number of clusters"):
        model.choose_model(model.sweep_k(points, [2, 3]))


def test_sample_is_exact_and_stable(spark):
    rows = vector_rows(spark, unit_rows(300, 2))
    one = {r["vec_id"] for r in fcm.sample_rows(rows.repartition(7), 50, "vec_id").collect()}
    two = {r["vec_id"] for r in fcm.sample_rows(rows.coalesce(1), 50, "vec_id").collect()}
    assert one == two and len(one) == 50
    other = {r["vec_id"] for r in fcm.sample_rows(rows, 50, "vec_id", seed=1).collect()}
    assert other != one
    assert fcm.sample_rows(rows, 5000, "vec_id").count() == 300


def test_stratified_sample(spark):
    sizes = {"a": 100, "b": 33, None: 33, "c": 7, "d": 1}
    data = [(f"{s}{i}", s, 1) for s, n in sizes.items() for i in range(n)]
    rows = spark.createDataFrame(data, "doc_id string, kind string, _seats int")
    for n in (0, 1, 2, 17, 60, 173, 174, 5000):
        got = fcm.stratified_rows(rows.repartition(5), "kind", n).collect()
        wanted, total = min(n, len(data)), len(data)
        seats = {s: c * wanted // total for s, c in sizes.items()}
        turn = sorted(sizes, key=lambda s: (-(sizes[s] * wanted % total), s is not None, s or ""))
        for s in turn[: wanted - sum(seats.values())]:
            seats[s] += 1
        key = lambda r: hashlib.md5(f"42:{r[0]}".encode()).hexdigest()
        expected = [r for s, c in seats.items() for r in sorted((r for r in data if r[1] == s), key=key)[:c]]
        assert sorted(r["doc_id"] for r in got) == sorted(r[0] for r in expected)
        assert rows.columns == ["doc_id", "kind", "_seats"] and len(got) == wanted
    assert fcm.stratified_rows(rows.limit(0), "kind", 5).count() == 0
    plan = fcm.stratified_rows(rows, "kind", 17)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan
    with pytest.raises(ValueError, match="negative"):
        fcm.stratified_rows(rows, "kind", -1)
