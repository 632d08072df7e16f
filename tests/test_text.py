import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpuscle.functions import text as tx
from corpuscle.operators import corpus, encode

from support import expected_body, expected_clean, expected_unquoted

CASES = [
    "From: a\nSubject: b\n\nhello\n> q\n\n\n\nworld\n-- \nsig",
    "no header\nfoo",
    "Note: x\nbody",
    "From: a\n  folded\nOrganization: z\n\nb",
    "\nstart",
    "",
    "From: a",
    "a\x85b\xa0c",
    "\xa0> q\nk\xa0",
    "X\xa0: y\n\nbody",
    "a\x1cb\x1fc",
    "From\n\nx\r\ny\rz",
    "Article-I.D.: 1\n\nq\n" + "-" * 10 + "\nz",
    "k\n" + "-" * 74 + "\nz",
    "k\n" + "-" * 11 + "\nz",
    "a\n\n \n\nb",
    "ok\n--",
    "--\nx",
    "From: a\n\n--\nx",
    ":x\n\ny",
    "K: kelvin\nx",
    "a: b\r\n\r\n c d　",
    "> only\n>> quotes",
    "Subject: a\n" * 40 + "\n" + "line\n" * 300,
]


def _cleaned(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, s string")
    s = F.col("s")
    return df.select(
        "i",
        tx.strip_headers(s).alias("headers"),
        tx.strip_quotes_and_signature(s).alias("quotes"),
        tx.clean_article(s).alias("clean"),
        tx.token_count(s).alias("tokens"),
        tx.fingerprint(s, 200).alias("opening"),
        tx.fingerprint(s).alias("fingerprint"),
    ).orderBy("i").collect()


def _check(rows, texts):
    for row, text in zip(rows, texts, strict=True):
        assert row["headers"] == "\n".join(expected_body(text))
        assert row["quotes"] == "\n".join(expected_unquoted(text.splitlines()))
        assert row["clean"] == expected_clean(text)
        assert row["tokens"] == len(text.split())
        assert row["opening"] == hashlib.md5(text[:200].encode()).hexdigest()
        assert row["fingerprint"] == hashlib.md5(text.encode()).hexdigest()


def test_edge_cases(spark):
    _check(_cleaned(spark, CASES), CASES)


_PIECES = st.sampled_from(
    ["From: a", "Subject:", "word", "x-y : z", "> q", "--", "-" * 10, " ", "\n", "\n\n", "\r\n",
     "\x0b", "\x1c", "\x1f", "\x85", "\xa0", " ", ":", "é", "Ärger", "\U0001f600"]
)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(_PIECES, max_size=12).map("".join), min_size=60, max_size=60))
def test_random_texts(spark, texts):
    _check(_cleaned(spark, texts), texts)


def test_latin1_keeps_every_byte(spark):
    df = spark.createDataFrame([(bytearray(range(256)),)], "content binary")
    assert corpus.decode_articles(df).first()["text"] == bytes(range(256)).decode("latin-1")


@pytest.mark.parametrize(
    "path, expected",
    [("r/c/f", ("c", "f", "c/f")), ("r/c/f/more", ("c", "f", "c/f")), ("r/f", None), ("f", None)],
)
def test_article_paths(spark, path, expected):
    row = corpus.article_paths(spark.createDataFrame([(path,)], "path string")).first()
    assert (None if row is None else (row["category"], row["filename"], row["doc_id"])) == expected


def _corpus(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [
        (4, "Subject: s\n\n" + long + " tail four"),
        (1, "too short"),
        (2, long + " tail two"),
        (3, " ".join(["x"] * 49)),
        (5, " ".join(["y"] * 50)),
        (6, " ".join(["y"] * 50)),
    ]
    return spark.createDataFrame(rows, "doc_seq bigint, text string").repartition(4)


def test_filter_then_first_of_each_fingerprint(spark):
    # Whole texts decide, or the first 200 characters; 2 comes before 4 in load order.
    kept = corpus.usable_corpus(_corpus(spark)).orderBy("doc_seq")
    assert [r["doc_seq"] for r in kept.collect()] == [2, 4, 5]
    openings = corpus.usable_corpus(_corpus(spark), chars=200).orderBy("doc_seq")
    assert [r["doc_seq"] for r in openings.collect()] == [2, 5]
    again = corpus.drop_copies(kept)
    assert again.count() == kept.count()


def test_one_pass_filter_equals_filter_of_cleaned(spark):
    raw = _corpus(spark)
    one_pass = corpus.clean_and_keep_long(raw)
    two_steps = corpus.keep_long_enough(corpus.clean_corpus(raw))
    assert sorted(one_pass.collect()) == sorted(two_steps.select(*one_pass.columns).collect())


def test_load_report(spark):
    row = corpus.load_report(_corpus(spark)).first()
    assert row.asDict() == {"files": 6, "kept": 3, "too_short": 2, "duplicates": 1, "opening_alike": 1}
    empty = corpus.load_report(_corpus(spark).limit(0)).first()
    assert row is not None and set(empty.asDict().values()) == {0}


def test_hot_fingerprint_is_limited_before_the_shuffle(spark):
    plan = corpus.usable_corpus(_corpus(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and plan.count("WindowGroupLimit") == 2


def test_first_documents(spark):
    kept = corpus.first_documents(_corpus(spark), 3)
    assert sorted(r["doc_seq"] for r in kept.collect()) == [1, 2, 3]


def test_embed_with_given_encoder_over_cleaned_text(spark):
    def load_lengths():
        import numpy as np

        return lambda texts: np.array([[len(t), 1.0] for t in texts])

    raw = spark.createDataFrame([(1, "From: a\n\nabc"), (2, "")], "doc_id int, text string")
    out = encode.embed_with(corpus.clean_corpus(raw), load_lengths).select("doc_id", "embedding")
    got = {r["doc_id"]: r["embedding"] for r in out.collect()}
    assert got[1] == pytest.approx([3 / 10**0.5, 1 / 10**0.5], abs=1e-6)
    assert got[2] == pytest.approx([0.0, 1.0])


def test_hashed_embedding_matches_term_hashing(spark):
    from pyspark.ml.feature import HashingTF

    texts = ["Red red blue", "green", "blue RED"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    rows = encode.embed(df).orderBy("i").collect()
    index = HashingTF(numFeatures=encode.DIMENSIONS).indexOf
    for row, text in zip(rows, texts):
        counts = [0.0] * encode.DIMENSIONS
        for word in text.lower().split():
            counts[index(word)] += 1
        norm = sum(c * c for c in counts) ** 0.5
        assert row["embedding"] == pytest.approx([c / norm for c in counts], abs=1e-6)
    weighted = encode.embed_hashed(df, idf=True).first()["embedding"]
    assert sum(x * x for x in weighted) == pytest.approx(1.0, abs=1e-5)
