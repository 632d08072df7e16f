"""Top-k against all scores."""

import math

import numpy as np
import pytest

from corpuscle.llm import topk


def _expected(queries, rows, k):
    ok = lambda v: v is not None and all(x is not None and math.isfinite(x) for x in v)
    whole = lambda v: [math.floor(1024.0 * x) for x in v]
    rows = [(i, whole(v)) for i, v in rows if i is not None and ok(v)]
    asked = {}
    for i, v in queries:
        if i is not None and ok(v):
            asked[i] = min(asked.get(i, v), v)
    out = []
    for q, v in asked.items():
        v = whole(v)
        scores = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in rows if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def _rows(seed, n, dim):
    rng = np.random.default_rng(seed)
    data = rng.normal(size=(n, dim)).astype(np.float32)
    data[n // 3 : n // 2] = data[0]
    return [(i, [float(x) for x in v]) for i, v in enumerate(data)]


def _frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id bigint, embedding array<float>, score int, query_id int")


@pytest.mark.parametrize(("dim", "block"), [(8, 4096), (3, 7), (33, 5)])
def test_against_all_scores(spark, monkeypatch, dim, block):
    monkeypatch.setattr(topk, "SCORES_AT_ONCE", 200)
    monkeypatch.setattr(topk, "KEPT_AT_ONCE", 50)
    rows = _rows(dim, 240, dim)
    queries = rows[::12]
    got = topk.top_k(_frame(spark, queries), _frame(spark, rows).repartition(5), query_block=block).collect()
    assert sorted(map(tuple, got)) == _expected(queries, rows, 10)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5]), (0, [0.25, 0.5]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 0.0]), (5, []), (6, [-1.0, 2.0])]
    rows += [(6, [-1.0, 2.0]), (7, [3.0]), (None, [1.0, 1.0]), (8, [0.5, 0.5, 0.5])]
    got = topk.top_k(_frame(spark, rows), _frame(spark, rows), k=4).collect()
    assert sorted(map(tuple, got)) == _expected(rows, rows, 4)


def test_empty_sides(spark):
    some, none = _frame(spark, _rows(1, 5, 2)), _frame(spark, [])
    assert topk.top_k(none, some).count() == topk.top_k(some, none).count() == 0
    assert topk.top_k(none, some).columns == ["query_id", "rank", "vec_id", "score"]
    assert topk.top_k(some.limit(1), some.limit(1)).count() == 0


def test_large_components(spark):
    rows = [(1, [1e6, 2.0]), (2, [2e6, 1.0]), (3, [1.0, 1.0]), (4, [-2e6, 3.0]), (5, [1e6, 1.0]), (6, [1.0, -1.0]), (7, []), (8, [0.001])]
    got = topk.top_k(_frame(spark, rows), _frame(spark, rows).repartition(3), k=3).collect()
    assert sorted(map(tuple, got)) == _expected(rows, rows, 3)
    assert max(r["score"] for r in got) > 1 << 60
    # Scores that floats can't tell apart, and components beyond doubles once they are scaled.
    rows = [(1, [1e9, 1.0]), (2, [2048.0, 1.0]), (3, [2048.0, 2.0]), (4, [2048.0, 3.0]), (5, [0.0, 1e306])]
    frame = lambda r: spark.createDataFrame(r, "vec_id bigint, embedding array<double>")
    got = topk.top_k(frame(rows[:1]), frame(rows[:4]), k=2).collect()
    assert sorted(map(tuple, got)) == _expected(rows[:1], rows[:4], 2)
    got = topk.top_k(frame([(9, [3.0, 0.0])]), frame(rows), k=5).collect()
    expected = [(-sum(a * b for a, b in zip([3072, 0], [math.floor(1024 * x) if x < 1e300 else int(x) * 1024 for x in v], strict=True)), i) for i, v in rows]
    assert [(r["score"], r["vec_id"]) for r in sorted(got, key=lambda r: r["rank"])] == [(-s, i) for s, i in sorted(expected)]


def test_scores_beyond_64_bits_raise(spark):
    big = _frame(spark, [(1, [1e12]), (2, [1e12])])
    with pytest.raises(Exception, match="beyond 64 bits"):
        topk.top_k(big, big).collect()
