"""Jaccard join against all pairs on small tables."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from corpuscle.llm import components as cc
from corpuscle.llm import hashing, jaccard


def _set(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def _expected(rows, k=5, percent=80):
    sets = [_set(t, k) for _, t in rows]
    comp = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and rows[i][0] is not None and rows[j][0] is not None:
                both = len(sets[i] & sets[j])
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    a, b = comp[i], comp[j]
                    comp = [a if c == b else c for c in comp]
    least = {}
    for (doc, _), c in zip(rows, comp, strict=True):
        if doc is not None:
            least[c] = min(doc, least.get(c, doc))
    return sorted(((d, len(s), least[c] if d is not None else None) for (d, _), s, c in zip(rows, sets, comp, strict=True)), key=repr)


def _rows(seed, n=120):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = rng.choices(vocabulary, k=30)
    bases = [rng.choices(vocabulary, k=rng.choice([1, 3, 5, 7, 12, 60, 150])) for _ in range(12)]
    rows = []
    for i in range(n):
        words = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
            at = rng.randrange(len(words))
            words[at : at + rng.choice([0, 1])] = [rng.choice(vocabulary)]
        if rng.random() < 0.3:
            words += passage
        rows.append((i, rng.choice([" ", "\n", "\t "]).join(w.upper() if rng.random() < 0.1 else w for w in words)))
    return rows


def _got(spark, rows, **options):
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "doc_id bigint, text string, n int, set_id string, component_id int")
    return sorted((tuple(r) for r in jaccard.similar_groups(docs.repartition(4), **options).collect()), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_against_all_pairs(spark, seed, monkeypatch):
    monkeypatch.setattr(jaccard, "FREQUENT_FROM", 4)
    monkeypatch.setattr(jaccard.frequent_shingles, "__defaults__", (5, 1000, 4))
    monkeypatch.setattr(jaccard, "PAGE", 5)
    monkeypatch.setattr(jaccard, "BLOCK", 3)
    rows = _rows(seed)
    assert _got(spark, rows) == _expected(rows)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a"), (5, "A"), (6, "a b"), (7, "a b c d"), (8, "a b c d e"), (9, "a a a a a a a a")]
    rows += [(10, "a a a a a"), (None, "a b c d e"), (None, None), (8, "a b c d e"), (8, "x y z u v w"), (11, "X y z u v w"), (12, "é\x00b c")]
    rows += [(13, "é\x00B c"), (-5, "a b c"), (14, "a b c"), (15, "long " + " ".join(f"t{i}" for i in range(30_000)))]
    rows += [(16, "other " + " ".join(f"t{i}" for i in range(30_000)))]
    assert _got(spark, rows) == _expected(rows)


def test_near_copies_and_other_thresholds(spark):
    rng = random.Random(9)
    base = [f"b{i}" for i in range(80)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(80)] = f"x{rng.randrange(10**6)}"
        rows.append((1000 - i, " ".join(words)))
    assert _got(spark, rows) == _expected(rows)
    assert _got(spark, rows[:60], percent=90, k=3) == _expected(rows[:60], 3, 90)


def test_empty_table(spark):
    assert _got(spark, []) == []


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(0, 300)] + [(1000 + rng.randrange(60), 1000 + rng.randrange(60)) for _ in range(50)]
    rng.shuffle(links)
    parent = {x: x for pair in links for x in pair if pair[0] != pair[1]}
    for _ in range(400):
        for a, b in links:
            if a != b:
                parent[a] = parent[b] = min(parent[a], parent[b])
    got = cc.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert {r["node"]: r["component"] for r in got} == parent


def test_hashes_tell_runs_apart():
    texts = [" ".join(map(str, range(i, i + 6))) for i in range(500)] + ["ab c", "a bc", "abc", None, "a\x00", "a"]
    found = [tuple(s.tolist()) for part in hashing.slices(pa.array(texts), 300) for s in jaccard.shingle_sets(part)]
    assert len(found) == len(texts) and len(set(found)) == len(texts)
    assert all(np.all(np.diff(np.array(s, dtype=np.uint64)) > 0) for s in found)
