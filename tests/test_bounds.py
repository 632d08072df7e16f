"""What bounds the memory and the reads of jobs over large tables."""

import time

import numpy as np
import pyarrow as pa
import pytest

from corpuscle import session
from corpuscle.functions.vectors import list_column
from corpuscle.operators import fcm
from corpuscle.plans import queries

from support import unit_rows, vector_rows


def test_workers_get_batches_bounded_by_bytes(spark):
    """unless the session states its own bound."""
    before = spark.conf.get(session.BATCH_BYTES, None)
    try:
        spark.conf.unset(session.BATCH_BYTES)
        session.bound_batches(spark)
        assert spark.conf.get(session.BATCH_BYTES) == "4m"
        spark.conf.set(session.BATCH_BYTES, "9m")
        session.bound_batches(spark)
        assert spark.conf.get(session.BATCH_BYTES) == "9m"
    finally:
        spark.conf.unset(session.BATCH_BYTES)
        if before is not None:
            spark.conf.set(session.BATCH_BYTES, before)


def test_a_pass_takes_a_batch_in_slices(monkeypatch):
    """the working memory of a pass doesn't follow the batch, and nothing is left out."""
    x, centres = unit_rows(2500, 4), unit_rows(3, 5)
    seen, whole = [], fcm.distances
    expected_u = fcm.membership_matrix(whole(x, centres), 2.0)
    monkeypatch.setattr(fcm, "distances", lambda points, *rest: seen.append(len(points)) or whole(points, *rest))
    batch = pa.RecordBatch.from_arrays([list_column(x), pa.array(np.arange(2500))], names=["embedding", "start_key"])
    (row,) = fcm._partial_sums([(3, centres, centres)], 2.0)(iter([batch]))
    sums = np.array(row["sums"][0].as_py())
    assert max(seen) <= fcm.POINTS_AT_ONCE
    assert np.allclose(sums[: centres.size], ((expected_u**2).T @ x).ravel())
    assert np.allclose(sums[centres.size : centres.size + 3], (expected_u**2).sum(axis=0))
    assert sums[-1] == 2500


def test_a_stream_reads_stored_documents(spark, tmp_path, monkeypatch):
    """vectors and texts are joined once, not once per read of every batch."""
    vectors = vector_rows(spark, unit_rows(12, 6)).selectExpr("vec_id", "embedding", "CAST(vec_id % 2 AS INT) AS label")
    vectors.write.parquet(str(tmp_path / "embeddings.parquet"))
    docs = spark.range(9).selectExpr("id AS doc_id", "'some text' AS text", "'en' AS lang", "'s' AS source", "9L AS n_chars")
    docs.write.parquet(str(tmp_path / "documents.parquet"))

    class Seen(Exception):
        pass

    def stream(spark, root, centres, documents, *rest, **options):
        raise Seen(documents)

    monkeypatch.setattr(queries, "QueryStream", stream)
    with pytest.raises(Seen) as seen:
        queries.stream_replay(spark, str(tmp_path))
    documents = seen.value.args[0]
    assert "Join" not in documents._jdf.queryExecution().optimizedPlan().toString()
    assert documents.count() == 12 and documents.filter("text IS NULL").count() == 3


def test_a_job_removes_its_shuffle_files(spark, tmp_path):
    """unless the session states otherwise, a query of many jobs keeps what one of them shuffles, not all."""
    before = spark.conf.get(session.DROP_SHUFFLES, None)
    rows = spark.range(50_000).selectExpr("id % 20011 AS k", "rand(1) AS v").groupBy("k").max("v")

    def known():
        return set(spark._jsc.sc().env().mapOutputTracker().shuffleStatuses().keySet().mkString(" ").split())

    def kept(name, wait):
        before = known()
        rows.write.parquet(str(tmp_path / name))
        until = time.time() + wait  # files are removed in the background
        while (new := known() - before) and time.time() < until:
            time.sleep(0.1)
        return len(new)

    try:
        spark.conf.set(session.DROP_SHUFFLES, "false")
        session.drop_shuffles(spark)
        assert kept("stated", 2) == 1
        spark.conf.unset(session.DROP_SHUFFLES)
        session.drop_shuffles(spark)
        assert kept("dropped", 30) == 0
        assert spark.read.parquet(str(tmp_path / "dropped")).count() == rows.count() == 20_011
    finally:
        spark.conf.unset(session.DROP_SHUFFLES)
        if before is not None:
            spark.conf.set(session.DROP_SHUFFLES, before)
