"""Decontamination against edit distances of all places."""

import random
import re

import pytest

from corpuscle.llm import decontaminate as dc


def _words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _best(pattern, text):
    """(distance, start, end): the first best end, then the shortest run."""
    row = [(i, 0) for i in range(len(pattern) + 1)]
    best = (len(pattern), 0)
    for j, word in enumerate(text):
        new = [(0, 0)]
        for i, p in enumerate(pattern):
            new.append((min(row[i][0] + (p != word), row[i + 1][0] + 1, new[i][0] + 1), 0))
        row = new
        if row[-1][0] < best[0]:
            best = (row[-1][0], j + 1)
    return best


def _expected(docs, items):
    out = []
    for d, text in docs:
        words = _words(text)
        for i, item in items:
            pattern = _words(item)
            if not pattern:
                continue
            if len(pattern) < dc.LEAST_WORDS:
                if words == pattern:
                    out.append((d, i, 0))
                continue
            distance = _best(pattern, words)[0]
            if distance <= len(pattern) * dc.ERRORS_PERCENT // 100:
                out.append((d, i, distance))
    return sorted(out, key=repr)


def _edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        at = rng.randint(0, len(words))
        words[at : at + rng.choice([0, 1])] = rng.choice([[], ["new"], [rng.choice("abcdef")]])
    return words


def _tables(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + list("abc")
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([2, 5, 6, 11, 30, 90])))) for i in range(20)]
    docs = []
    for d in range(150):
        words = rng.choices(vocabulary, k=rng.choice([0, 3, 40, 200]))
        if rng.random() < 0.7:
            at = rng.randint(0, len(words))
            words[at:at] = _edited(rng, _words(rng.choice(items)[1]), rng.choice([0, 1, 3, 6, 12]))
        docs.append((d, rng.choice([" ", ", ", "\n"]).join(w.upper() if rng.random() < 0.2 else w for w in words)))
    docs += [(900, items[0][1]), (901, None), (902, ""), (None, items[5][1]), (903, "x " * 40_000 + items[5][1]), (3, docs[3][1])]
    return docs, [*items, (77, None), (78, ""), (5, "another text with the key five in it")]


@pytest.mark.parametrize(("seed", "block"), [(1, 10**6), (2, 60)])
def test_against_all_places(spark, seed, block):
    docs, items = _tables(seed)
    frame = spark.createDataFrame([(*r, "c", 3) for r in docs], "doc_id bigint, text string, item_id string, n_errors int").repartition(4)
    bench = spark.createDataFrame([*items, (None, docs[0][1])], "item_id bigint, text string")
    got = dc.find_hits(frame, bench, block_words=block).collect()
    assert sorted(((r[0], r[1], r[2]) for r in got), key=repr) == _expected(docs, items)
    by_doc = {d: _words(t) for d, t in docs}
    for r in got:
        if r["doc_id"] not in (3, None) and r["item_id"] != 5:
            pattern, run = _words(dict(items)[r["item_id"]]), by_doc[r["doc_id"]][r["first_word"] : r["last_word"] + 1]
            assert _best(pattern, run)[0] == r["n_errors"] <= r["error_budget"]
    hit = {(r["doc_id"]) for r in got}
    kept = dc.remove_contaminated(frame, bench, block_words=block)
    assert kept.columns == frame.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted((d for d, _ in docs if d not in hit), key=repr)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id bigint, text string")
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert dc.find_hits(docs, none).count() == 0 and dc.remove_contaminated(docs, none).count() == 1
    bench = spark.createDataFrame([(1, "a b c d e f")], "item_id bigint, text string")
    assert dc.find_hits(docs.limit(0), bench).count() == 0 and dc.find_hits(docs, bench).count() == 1


def test_distance_places():
    assert dc.place([1, 2, 3], [9, 1, 2, 3, 9]) == (0, 1, 4)
    assert dc.place([1, 2, 3], [9, 1, 3, 9])[0] == 1
    assert dc.place([1], []) == (1, 0, 0)


def test_short_items_within_texts(spark):
    """Every item of fewer words than ``LEAST_WORDS`` at its first exact place, longer ones as without the option."""
    docs, items = _tables(4)
    items = [*items, (50, "w1"), (51, "W2, w3"), (52, "a b c"), (53, "w1")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    expected = []
    for d, text in docs:
        words = _words(text)
        for i, item in items:
            pattern = _words(item)
            n = len(pattern)
            at = next((a for a in range(len(words) - n + 1) if words[a : a + n] == pattern), None)
            if 0 < n < dc.LEAST_WORDS and at is not None:
                expected.append((d, i, 0, 0, at, at + n - 1, n))
    for block in (10**6, 60):
        got = list(map(tuple, dc.find_hits(frame, bench, block_words=block, short_within=True).collect()))
        assert sorted((r for r in got if r[6] < dc.LEAST_WORDS), key=repr) == sorted(expected, key=repr)
        longer = [tuple(r) for r in dc.find_hits(frame, bench, block_words=block).collect() if r["n_item_words"] >= dc.LEAST_WORDS]
        assert sorted((r for r in got if r[6] >= dc.LEAST_WORDS), key=repr) == sorted(longer, key=repr)
    kept = dc.remove_contaminated(frame, bench, short_within=True).collect()
    hit = {r[0] for r in got}
    assert sorted((r["doc_id"] for r in kept), key=repr) == sorted((d for d, _ in docs if d not in hit), key=repr)


def test_registered_query_finds_short_items(spark, tmp_path):
    from corpuscle.llm import queries

    spark.createDataFrame([(1, "it is said that Paris is the capital of France today")], "doc_id bigint, text string").write.parquet(
        str(tmp_path / "documents.parquet")
    )
    spark.createDataFrame([(7, "capital of France")], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert [tuple(r) for r in queries.op7_pigeonhole_decontamination(spark, str(tmp_path)).collect()] == [(1, 7, 0, 0, 7, 9, 3)]
