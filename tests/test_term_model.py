"""Weighted terms against a plain statement."""

import hashlib
import math
import re
from collections import Counter

import numpy as np

from corpuscle.operators import term_model

DIM = 32


def _buckets(text):
    return [int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % DIM for w in re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())]


def test_stored_weights_serve_documents_and_queries(spark, tmp_path):
    docs = ["One two two.", "two three", "", None, "ÉTÉ two three", "one\ttwo\n" * 3000]
    queries = ["three one", "unseen words only", "", "two"]
    frame = lambda texts: spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "id int, text string, embedding int")
    term_model.save(spark, term_model.fit(frame(docs), dimensions=DIM), str(tmp_path / "terms"))
    model = term_model.load(spark, str(tmp_path / "terms"))
    held = Counter(b for t in docs for b in set(_buckets(t)))
    assert model.documents == len(docs) and model.frequencies.tolist() == [held[i] for i in range(DIM)]
    for texts in (docs, queries):
        for row in term_model.embed(frame(texts).repartition(2), model).collect():
            counts = Counter(_buckets(texts[row["id"]]))
            raw = np.array([counts[i] * math.log((len(docs) + 1) / (held[i] + 1)) for i in range(DIM)])
            norm = np.linalg.norm(raw)
            np.testing.assert_allclose(row["embedding"], raw / norm if norm else raw, atol=1e-12)


def test_empty_table(spark):
    none = spark.createDataFrame([], "text string")
    model = term_model.fit(none, dimensions=DIM)
    assert model.documents == 0 and term_model.embed(none, model).count() == 0
