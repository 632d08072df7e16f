"""The labelled sample keeps its bound."""

from pyspark.sql import functions as F

from corpuscle.llm.labelled import labelled_sample


def test_one_row_per_key(spark):
    docs = [(1, f"text {i}") for i in range(50)] + [(2, "b"), (2, None), (3, None), (4, "d"), (None, "e"), (6, "f")]
    labels = [(1, 0), (1, 1), (2, 0), (3, 1), (4, None), (None, 1), (6, 1), (6, 1)]
    docs = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    labels = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    free = {r[0] for r in labels.filter("crc32(cast(doc_id as string)) % 5 != 0").select("doc_id").collect()}
    expected = {r for r in [(1, "text 0", 1), (2, "b", 0), (3, None, 1), (6, "f", 1)] if r[0] in free}
    assert 1 in free
    got = labelled_sample(docs, labels, F.col("toxic"), 100).collect()
    assert len(got) == len(expected) and {tuple(r) for r in got} == expected
    assert labelled_sample(docs, labels, F.col("toxic"), 1).count() == 1
