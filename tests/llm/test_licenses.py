"""Licence scan against a plain regular expression, and edited notices."""

import random
import re

import pytest

from corpuscle.llm import hashing, licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _base(text):
    words, places, labels = _words(text), [], set()
    for phrase, label in licenses.BASE_PHRASES.items():
        wanted = phrase.split()
        for i in range(len(words)):
            if words[i : i + len(wanted)] == wanted:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def _rows():
    rng = random.Random(3)
    parts = ["MIT", "License", "license", "apache", "CC", "by", "gnu", "General", "public", "é", "x-y", "…", "by-nc", "\n", "0", "mit license", "\x00"]
    rows = [(i, rng.choice([" ", "-", "."]).join(rng.choices(parts, k=rng.choice([0, 1, 3, 30, 300])))) for i in range(80)]
    return [*rows, (None, "MIT License"), (7, None), (8, ""), (9, "mit license"), (9, "mit license"), (10, "MIT License, mit  license")]


def test_words_match_the_rule():
    for _, text in _rows():
        if text:
            words = hashing.text_words(text, hashing.ALNUM)
            data = re.sub("[A-Z]", lambda m: m[0].lower(), text).encode()
            assert [data[a:b].decode() for a, b in zip(words.start, words.end, strict=True)] == _words(text)


def test_base_columns(spark):
    docs = spark.createDataFrame([(a, b, 1, "x") for a, b in _rows()], "doc_id bigint, text string, at int, label string").repartition(5)
    got = licenses.scan(docs).collect()
    key = lambda r: tuple(map(repr, r))
    assert sorted(((r[0], *r[1:6]) for r in got), key=key) == sorted(((d, *_base(t)) for d, t in _rows()), key=key)
    for r in got:
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1 and (r["score"] == 1 or not r["n_base"])


@pytest.mark.parametrize("label", sorted(licenses.TEXTS))
def test_edited_notices(spark, label):
    rng = random.Random(label)
    whole = licenses.TEXTS[label]
    words = whole.split()
    edited = [w for w in words if rng.random() > 0.02]
    edited.insert(len(edited) // 2, "and so on")
    filler = " ".join(f"w{i}" for i in range(500))
    rows = [(1, f"{filler} {whole.upper()} {filler}"), (2, f"{filler} {' '.join(edited)}"), (3, " ".join(words[len(words) // 2 : len(words) * 3 // 4])), (4, filler)]
    got = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert label in got[1]["labels"].split(",") and label in got[2]["labels"].split(",")
    assert label not in got[3]["labels"].split(",") and 0 < got[3]["score"] < 1
    assert got[4]["labels"] == "" and got[4]["score"] == 0


def test_empty_table(spark):
    assert licenses.scan(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
