"""Product codes against plain rounds over Python numbers."""

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest

from corpuscle.llm import codes


def _expected(rows, parts=8, entries=16, rounds=6):
    ok = lambda v: v is not None and all(x is not None and math.isfinite(x) for x in v)
    rows = [(i, label, [math.floor(4096 * x) for x in v]) for i, v, label in rows if ok(v)]
    width = max(1, -(-max((len(v) for *_, v in rows), default=0) // parts))
    rows = [(i, label, v + [0] * (parts * width - len(v))) for i, label, v in rows]
    cut = [[v[p * width : (p + 1) * width] for *_, v in rows] for p in range(parts)]
    seeds = sorted(range(len(rows)), key=lambda r: (rows[r][0] is None, rows[r][0] or 0, rows[r][2]))[:entries]
    books = [[list(cut[p][r]) for r in seeds] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    for turn in range(rounds + 1):
        nearest = [[min((far(x, c), e) for e, c in enumerate(books[p])) for x in cut[p]] for p in range(parts)]
        for p in range(parts if turn < rounds else 0):
            for e in range(len(books[p])):
                mine = [x for x, (_, own) in zip(cut[p], nearest[p], strict=True) if own == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    sha = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    error = [sum(nearest[p][r][0] for p in range(parts)) for r in range(len(rows))]
    by_label = defaultdict(int)
    for (_, label, _), e in zip(rows, error, strict=True):
        by_label[label] += e
    out = []
    for r, (i, label, _) in enumerate(rows):
        out.append((i, "".join(f"{nearest[p][r][1]:02x}" for p in range(parts)), error[r], by_label[label], sha))
    return sorted(out, key=repr)


def _frame(spark, rows):
    return spark.createDataFrame(
        [(i, v, label, 1, 2, 3) for i, v, label in rows], "vec_id bigint, embedding array<double>, label int, row int, part int, size int"
    )


def _got(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize(("dim", "block"), [(16, 128), (64, 7), (21, 16), (3, 4)])
def test_against_plain_rounds(spark, dim, block):
    rng = np.random.default_rng(dim)
    data = rng.normal(scale=0.2, size=(300, dim)).astype(np.float32).astype(float)
    data[100:180] = data[0]
    rows = [(i, v.tolist(), None if i % 5 == 0 else i % 3) for i, v in enumerate(data)]
    assert _got(codes.encode(_frame(spark, rows).repartition(6), block=block)) == _expected(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, None, 1), (1, [1.0, None], 1), (2, [nan, 1.0], 1), (3, [inf, 1.0], 1), (4, [], 1), (5, [0.5], None), (5, [0.5], None)]
    rows += [(5, [0.25, 0.5], 2), (None, [1.0] * 9, 2), (7, [-0.0001] * 9, 2)]
    assert _got(codes.encode(_frame(spark, rows))) == _expected(rows)
    assert codes.encode(_frame(spark, rows[:4])).collect() == []
    assert codes.encode(_frame(spark, [])).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_large_components_stay_exact(spark):
    rows = [(i, [1e6 * (i % 3 + 1), -1e6, 0.5 * i, 1e-9], 0) for i in range(40)] + [(99, [1e12, 1.0, 0.0, 0.0], 1)]
    assert _got(codes.encode(_frame(spark, rows), block=8)) == _expected(rows)


def test_every_cell_once_along_the_curve():
    side = np.arange(8)
    points = np.stack(np.meshgrid(side, side, side), -1).reshape(-1, 3).astype(float)
    place = codes.hilbert(points, np.zeros(3), np.full(3, 8.0))
    path = points[np.argsort(place)]
    assert len(set(place.tolist())) == 512
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_shortlist_holds_every_nearest_entry():
    rng = np.random.default_rng(3)
    shorter = 0
    for _ in range(200):
        points = rng.integers(-20, 20, 8) + rng.integers(0, 9, (30, 8))
        book = rng.integers(-40, 40, (16, 8))
        near = codes.shortlist(points.min(0), points.max(0), book)
        nearest = ((points[:, None] - book) ** 2).sum(2)
        assert set(nearest.argmin(1)) <= set(near) and set(np.nonzero(nearest == nearest.min(1)[:, None])[1]) <= set(near)
        shorter += len(near) < 16
    assert shorter > 150


def test_entries_need_two_digits(spark):
    with pytest.raises(ValueError, match="two hexadecimal digits"):
        codes.encode(_frame(spark, []), entries=257)
