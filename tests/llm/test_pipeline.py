"""The pipeline's stages against the operators' own results, and odd rows through all of them."""

from pathlib import Path

import pytest

import corpus_pipeline
from corpuscle.llm import decontaminate, jaccard, ordinal, packing, queries, toxicity

TABLES = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(TABLES).exists(), reason="test tables are not here")
def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    labels = spark.read.parquet(f"{TABLES}/labels.parquet")
    benchmark = spark.read.parquet(f"{TABLES}/benchmark.parquet")
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, TABLES)
        assert out.columns == docs.columns
        kept.append((docs, ids(docs), ids(out)))
        docs = spark.createDataFrame(out.collect(), docs.schema)
    (d, before, after), *_ = kept
    assert after == before - ids(toxicity.score(d, toxicity.fit(d, labels)).filter("predicted = 1"))
    d, before, after = kept[1]
    assert after == ids(ordinal.score(d, ordinal.fit(d, labels, queries.grade(), queries.GRADES)).filter("keep"))
    d, before, after = kept[2]
    assert after == ids(jaccard.similar_groups(d).filter("doc_id = component_id"))
    d, before, after = kept[3]
    assert after == before - ids(decontaminate.find_hits(d, benchmark)) and len(after) < len(before)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, TABLES)
    key = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted(r[:5] for r in map(tuple, packed.collect())) == sorted(map(tuple, packing.pieces(docs).select(*key).collect()))
    whole = queries.queries()["pipeline"](spark, TABLES)
    assert whole.columns == [*key, "sequence_id", "offset"] and ids(whole) == after


def test_odd_rows(spark, tmp_path):
    rows = [(1, None), (2, ""), (None, "no key"), (3, "a b c d e f"), (3, "a b c d e f"), (4, "A b c d e f"), (5, "long " * 30_000)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0, "extra", 1) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, label string, _copies2 int")
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    none.write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, None)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert len(docs.columns) == 7
    assert sorted((str(r["doc_id"]) for r in docs.collect())) == ["1", "2", "3", "5", "None"]
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() >= 5
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, str(tmp_path))
    assert empty.count() == 0
