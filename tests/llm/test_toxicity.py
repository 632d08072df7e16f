"""Toxicity: held-out accuracy, and rows of all kinds."""

import random
import zlib

import numpy as np

from corpuscle.llm import toxicity

STEMS = ("zarkel", "plomvi", "tunzor", "grebax")


def _corpus(seed, n):
    rng = random.Random(seed)
    syllables = ["ka", "lo", "mi", "ter", "san", "vo", "rel", "ni", "é", "ou"]
    word = lambda: "".join(rng.choices(syllables, k=rng.randint(1, 4)))
    rows, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.choice([3, 20, 80, 400]))]
        toxic = rng.random() < 0.15
        if toxic:
            for _ in range(rng.randint(2, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(STEMS) + word())
        rows.append((i, " ".join(words), "xx", "src"))
        if i % 2 == 0:
            labels.append((i, 1, int(toxic)))
    return rows, labels


def test_held_out_rows(spark):
    rows, labels = _corpus(4, 3000)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").repartition(4)
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    got = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    truth = {i: any(s in text for s in STEMS) for i, text, _, _ in rows}
    assert len(got) == len(rows)
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r["score"] <= 1
        assert r["predicted"] == int(r["score"] >= 0.5)
    wrong = [i for i, r in got.items() if bool(r["predicted"]) != truth[i] and r["held_out"]]
    assert len(wrong) <= 0.02 * len(rows) / 5


def test_odd_rows_and_no_labels(spark):
    rows = [(1, None), (2, ""), (3, "You IDIOT, you pathetic loser"), (None, "fine"), (3, "You IDIOT, you pathetic loser"), (4, "Imbécile " * 9000), (5, "a calm text"), (6, "IMBÉCILE crétin")]
    docs = spark.createDataFrame([(*r, 0.5, 1) for r in rows], "doc_id bigint, text string, score double, held_out int")
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    for labels in (none, spark.createDataFrame([(1, 1), (None, 1), (2, None), (77, 0)], "doc_id bigint, toxic int")):
        model = toxicity.fit(docs, labels)
        got = toxicity.score(docs, model).collect()
        assert sorted((str(r["doc_id"]), r["predicted"]) for r in got) == [
            ("1", 0), ("2", 0), ("3", 1), ("3", 1), ("4", 1 if model.features.size == 0 else got[5]["predicted"]), ("5", 0), ("6", 1), ("None", 0)
        ]
    assert toxicity.score(docs.limit(0), model).count() == 0
    assert toxicity.fit(docs.limit(0), none).bias < 0


def test_label_model_recovers_accuracies():
    rng = np.random.default_rng(2)
    n = 4000
    y = rng.random(n) < 0.2
    columns = []
    for hit, false in ((0.7, 0.01), (0.5, 0.02), (0.4, 0.01), (0.3, 0.3)):
        columns.append(np.where(np.where(y, rng.random(n) < hit, rng.random(n) < false), 1, -1))
    columns.insert(1, columns[0])  # a voter that repeats another
    votes = np.stack([*columns, np.where((np.stack(columns[:4]) == 1).any(axis=0), -1, 0)], axis=1).astype(np.int8)
    posterior, accuracy, groups = toxicity.label_model(votes, 4)
    assert [0, 1] in groups
    assert accuracy[0] > 0.85 > accuracy[4]
    assert ((posterior > 0.5) == y).mean() > 0.93
