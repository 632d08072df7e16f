from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpuscle.functions import vectors as vc
from corpuscle.operators import cache, matching, ordering, search
from corpuscle.operators.matching import top_matches
from corpuscle.sources.shared import shared_dir

from support import unit_rows, vector_rows

N = 120


@pytest.fixture(scope="module")
def data():
    rows = unit_rows(N, 5)
    rows[40:80] = rows[7]  # a third of all rows are copies of one vector
    return rows


def _nearest(data, n, allowed=None):
    scores = np.round(data @ data.T, 12)
    out = {}
    for i in range(len(data)):
        ids = range(len(data)) if allowed is None else allowed[i]
        out[i] = sorted(ids, key=lambda j: (-scores[i, j], j))[:n]
    return out


def _ids(found, query="query", entry="entry", rank="rank"):
    got = {}
    for row in found.collect():
        got.setdefault(row[query], {})[row[rank]] = row[entry]
    return {q: [ranks[r] for r in sorted(ranks)] for q, ranks in got.items()}


@pytest.mark.parametrize(
    "limits",
    [{}, {"travel_rows": N - 1 + 1, "block_rows": 7}, {"travel_rows": 0, "block_rows": 17}, {"travel_rows": 0, "block_rows": 1000}],
)
def test_exact_search_with_ties(spark, data, limits):
    docs = vector_rows(spark, data, "doc_id").repartition(5)
    queries = vector_rows(spark, data, "seq", "vector").repartition(3)
    found = search.nearest_documents(docs, queries, 4, **limits)
    assert _ids(found, "seq", "doc_id", "id") == _nearest(data, 4)


def test_few_entries_travel_to_many_queries(spark, data):
    docs = vector_rows(spark, data[:30], "doc_id")
    queries = vector_rows(spark, data, "seq", "vector").repartition(6)
    found = top_matches(
        docs, queries, 3, entry_id="doc_id", query_id="seq", query_vector="vector", travel_rows=50
    )
    expected = _nearest(data, 3, {i: range(30) for i in range(N)})
    assert _ids(found) == expected


@pytest.mark.parametrize("limits", [{}, {"travel_rows": 0, "block_rows": 9}])
def test_pruned_search_equals_search_in_the_nearest_clusters(spark, data, limits):
    centres = unit_rows(6, 9)
    nearest = np.argsort(np.linalg.norm(data[:, None] - centres[None], axis=2), axis=1)
    docs = cache.assign_clusters(vector_rows(spark, data, "doc_id"), centres, "embedding")
    queries = vector_rows(spark, data, "seq", "vector")
    found = search.nearest_documents_pruned(docs, queries, centres, 2, 4, **limits)
    allowed = {
        i: [j for j in range(N) if nearest[j, 0] in nearest[i, :2]] for i in range(N)
    }
    assert _ids(found, "seq", "doc_id", "id") == _nearest(data, 4, allowed)
    # With every cluster visited the pruned search is the exact one.
    everything = search.nearest_documents_pruned(docs, queries, centres, 6, 4, **limits)
    assert _ids(everything, "seq", "doc_id", "id") == _nearest(data, 4)


def test_text_ids(spark, data):
    docs = vector_rows(spark, data, "n").select(F.format_string("d%03d", "n").alias("doc_id"), "embedding")
    queries = vector_rows(spark, data[:10], "seq", "vector")
    found = search.nearest_documents(docs, queries, 2)
    expected = {i: [f"d{j:03d}" for j in ids] for i, ids in _nearest(data, 2).items() if i < 10}
    assert _ids(found, "seq", "doc_id", "id") == expected


def test_empty_sides(spark, data):
    docs = vector_rows(spark, data, "doc_id")
    queries = vector_rows(spark, data[:3], "seq", "vector")
    assert search.nearest_documents(docs.limit(0), queries, 2).count() == 0
    assert search.nearest_documents(docs, queries.limit(0), 2).count() == 0


def test_hits_are_shaped_in_rank_order(spark, data):
    docs = vector_rows(spark, data[:20], "doc_id").select(
        "*", F.lit("cat").alias("category"), F.concat(F.lit("  t"), F.col("doc_id"), F.lit("\n")).alias("text")
    )
    queries = vector_rows(spark, data[:2], "seq", "vector")
    found = search.nearest_documents(docs, queries, 3)
    lists = search.hit_lists(search.search_hits(found, docs)).orderBy("seq").collect()
    assert [h["id"] for h in lists[0]["result"]] == [1, 2, 3]
    assert lists[1]["result"][0].asDict() == {"id": 1, "category": "cat", "similarity": 1.0, "text": "t1"}


def test_normalize_keeps_the_zero_vector(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<float>")
    rows = [r[0] for r in df.select(vc.l2_normalize(F.col("v"))).collect()]
    assert rows == [[0.6, 0.8], [0.0, 0.0]]


def test_dense_index_over_many_ranges(spark):
    seqs = sorted((np.random.default_rng(3).choice(10**6, 500, replace=False) * 1_000_003).tolist())
    df = spark.createDataFrame([(s, s % 7) for s in seqs], "seq bigint, m bigint").repartition(7)
    indexed = ordering.with_dense_index(df, "seq", "i")
    assert [r["i"] for r in indexed.orderBy("seq").collect()] == list(range(500))
    by_two = ordering.with_dense_index(df, ["m", "seq"], "i").orderBy("m", "seq").collect()
    assert [r["i"] for r in by_two] == list(range(500))
    assert ordering.with_dense_index(df.limit(0), "seq", "i").count() == 0


@pytest.mark.parametrize("rows", [[[1.0, 2.0], [3.0, 4.0, 5.0, 6.0]], [None, [3.0, 4.0]], [[1.0, None], [1.0, 2.0]]])
def test_matrix_refuses_rows_that_are_none(rows):
    with pytest.raises(ValueError):
        vc.matrix(pa.array(rows, pa.list_(pa.float64())))


@pytest.mark.parametrize("spread", [0.05, 0.4, 3.0])
def test_certified_search_is_exact(spark, spread):
    rng = np.random.default_rng(3)
    middle = unit_rows(8, 1)
    own = rng.integers(0, 7, 400)  # one cluster stays empty
    own[100:150] = own[0]
    rows = middle[own] + spread * rng.normal(size=(400, middle.shape[1]))
    rows = (rows / np.linalg.norm(rows, axis=1, keepdims=True)).astype(np.float32).astype(float)
    rows[100:150] = rows[0]  # ties go to the smaller id
    docs = vector_rows(spark, rows, "doc_id").withColumn("dominant_cluster", F.element_at(F.array(*[F.lit(int(c)) for c in own]), F.col("doc_id").cast("int") + 1))
    queries = vector_rows(spark, rows[::9], "seq", "vector")
    exact = search.nearest_documents(docs, queries, 5)
    found, read = search.nearest_documents_certified(docs, queries, middle, 5)
    assert sorted(map(tuple, found.select("seq", "doc_id", "id").collect())) == sorted(map(tuple, exact.select("seq", "doc_id", "id").collect()))
    visited = [r["clusters_read"] for r in read.collect()]
    assert len(visited) == queries.count() and max(visited) <= 7
    if spread < 0.1:
        assert sum(visited) <= 3 * len(visited)


def test_certified_search_without_rows(spark):
    docs = vector_rows(spark, unit_rows(4, 1), "doc_id").withColumn("dominant_cluster", F.lit(0))
    queries = vector_rows(spark, unit_rows(2, 2), "seq", "vector")
    for d, q, hits, reads in ((docs.limit(0), queries, 0, 2), (docs, queries.limit(0), 0, 0), (docs, queries, 8, 2)):
        found, read = search.nearest_documents_certified(d, q, unit_rows(1, 3), 5)
        assert (found.count(), read.count()) == (hits, reads)


def test_blocks_of_a_bucket_do_not_follow_its_rows(spark):
    """a row travels once per block of the other side, so their number is bounded until blocks are at their longest."""
    for rows, longest, expected in [(3, 1000, 2), (600, 1000, 5), (1200, 1000, 5), (1200, 100, 12)]:
        side = spark.range(rows).selectExpr("id AS entry", "0L AS bucket")
        assert matching._blocks(side, "n", 2, 5, longest).first()["n"] == expected


def test_a_side_is_held_as_it_is_stored():
    """only parts of a block are widened to doubles."""
    vectors = pa.array([[1.0, 2.0], [3.0, 4.0]], pa.list_(pa.float32()))
    side = matching._Rows.of(pa.table({"entry": [2, 1], "bucket": [0, 0], "vector": vectors}), "entry")
    assert side.vectors.dtype == np.float32
    assert side.part(np.array([1])).dtype == np.float64 and side.part(np.array([1])).tolist() == [[3.0, 4.0]]


def test_no_vectors_are_broadcast(spark, tmp_path):
    """the table of blocks is sent to the executors, never a side with its vectors."""
    vector_rows(spark, unit_rows(40, 3)).write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    found = top_matches(rows, rows, 2, entry_id="vec_id", query_id="vec_id", travel_rows=0, block_rows=9)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BuildRight") == 2 and "BuildLeft" not in plan


@pytest.mark.parametrize("block_rows, entries, earlier", [(20, 240, False), (20, 60, False), (20, 240, True), (8, 240, False)])
def test_large_sides_are_matched_in_pieces(spark, monkeypatch, block_rows, entries, earlier):
    """where a bucket needs more blocks than a row may travel, no vector is shuffled once per block of the other side."""
    monkeypatch.setattr(matching, "BLOCK_BYTES", 0)
    monkeypatch.setattr(matching, "GROUPS_PER_CORE", 1)  # two blocks a side
    monkeypatch.setattr(matching, "_block_pairs", None)
    rows = unit_rows(240, 9)
    rows[30:90] = rows[11]  # ties go to the smaller id
    side = vector_rows(spark, rows, "seq", "vector").withColumn("bucket", (F.col("seq") % 3 == 0).cast("bigint"))
    limits = {"travel_rows": 0, "block_rows": block_rows, "earlier": earlier, "bucket": "bucket"}
    asked = {"entry_id": "seq", "query_id": "seq", "entry_vector": "vector", "query_vector": "vector"}
    found = top_matches(side.filter(F.col("seq") < entries), side, 4, **asked, **limits)
    assert not [path for path in Path(shared_dir(spark)).iterdir() if path.name.startswith("match-sides")]
    got = {}
    for r in found.orderBy("query", "rank").collect():
        assert r["rank"] == len(got.setdefault(r["query"], [])) + 1
        got[r["query"]].append(r["entry"])
    allowed = [[j for j in range(entries) if (j % 3 == 0) == (i % 3 == 0) and not (earlier and j >= i)] for i in range(240)]
    assert got == {i: ids for i, ids in _nearest(rows, 4, allowed).items() if ids}


def test_a_query_in_several_buckets_has_one_ranking(spark, monkeypatch):
    """its rows may lie in different pieces."""
    rows = unit_rows(60, 10)
    docs = vector_rows(spark, rows, "doc_id").withColumn("dominant_cluster", F.col("doc_id") % 5)
    queries = vector_rows(spark, rows, "seq", "vector")
    visits = queries.withColumn("dominant_cluster", F.explode(F.array(F.lit(0), F.lit(2), F.lit(3)).cast("array<bigint>")))
    monkeypatch.setattr(matching, "BLOCK_BYTES", 0)
    monkeypatch.setattr(matching, "GROUPS_PER_CORE", 1)
    found = top_matches(
        docs, visits, 3, entry_id="doc_id", query_id="seq", query_vector="vector", bucket="dominant_cluster",
        several_buckets=True, travel_rows=0, block_rows=3,
    )
    got = {}
    for r in found.orderBy("query", "rank").collect():
        got.setdefault(r["query"], []).append(r["entry"])
    allowed = [[j for j in range(60) if j % 5 in (0, 2, 3)]] * 60
    assert got == _nearest(rows, 3, allowed)


@pytest.mark.parametrize("stored", [np.float32, np.float64])
@pytest.mark.parametrize("scale", [1.0, 250.0, 1e20])
@pytest.mark.parametrize("earlier", [False, True])
def test_scanned_batches_keep_the_exact_best(stored, scale, earlier):
    """F1: products in single precision only tell what is too low, also with ties and near ties."""
    rng = np.random.default_rng(6)
    rows = unit_rows(3000, 7, 24)
    rows[1000:1400] = rows[5]
    rows[1400:1800] = rows[5] + 1e-7 * rng.normal(size=(400, 24))
    rows = (rows * scale).astype(stored)
    ids = rng.permutation(3000)

    def side(name, at):
        vectors = pa.array(list(rows[at]), pa.list_(pa.from_numpy_dtype(stored)))
        return pa.table({name: ids[at], "bucket": np.zeros(len(at), np.int64), "vector": vectors})

    asked = np.arange(0, 1500, 3)
    batches = side("entry", np.arange(3000)).to_batches(max_chunksize=700)
    found = [b.to_pandas() for b in matching._scan_entries(side("query", asked), 5, earlier)(iter(batches))]
    got = {q: f["entry"].tolist() for q, f in found[0].groupby("query")}
    scores = np.rint((rows[asked].astype(float) @ rows.astype(float).T) * 10.0**12)
    for i, q in enumerate(ids[asked]):
        ok = np.flatnonzero(ids < q) if earlier else np.arange(3000)
        best = ok[np.lexsort((ids[ok], -scores[i, ok]))[:5]]
        if scale == 1e20:  # sums differ in their last digits, far above the twelfth
            assert np.allclose(np.sort(found[0]["score"][found[0]["query"] == q]), np.sort(scores[i, best] / 1e12))
        else:
            assert got.get(q, []) == ids[best].tolist()


def test_a_block_is_told_by_its_products_in_single_precision(monkeypatch):
    """after the first entries of a scan only the cells near a query's best are done in doubles."""
    rows = unit_rows(6000, 8, 32).astype(np.float32)

    def side(name):
        vectors = pa.array(list(rows), pa.list_(pa.float32()))
        return pa.table({name: np.arange(6000), "bucket": np.zeros(6000, np.int64), "vector": vectors})

    seen, whole = [], matching._candidates
    monkeypatch.setattr(matching, "_candidates", lambda *args: seen.append(whole(*args)) or seen[-1])
    list(matching._scan_entries(side("query"), 5, False)(iter(side("entry").to_batches(max_chunksize=1000))))
    assert sum(cells is None for cells in seen) <= len(seen) / 3
