from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuscle.operators import cache, replay, requests, thresholds
from corpuscle.sources import cache_store
from corpuscle.streaming import query_stream
from corpuscle.streaming.query_stream import LOG_SCHEMA, QueryStream

from support import DIM, log_rows, serial_replay, unit, unit_rows, vector_rows

HIT = [(1, "sci", 0.95, "a document")]


@pytest.fixture(scope="module")
def centres():
    c = np.random.default_rng(0).random((4, DIM))
    return c / np.linalg.norm(c, axis=1, keepdims=True)


def _state(spark, centres, rows, threshold=0.8):
    """Entries from (seq, query, vector)."""
    df = spark.createDataFrame(
        [(s, q, [float(x) for x in v], HIT) for s, q, v in rows],
        f"seq bigint, query string, vector array<float>, result {cache.HIT_TYPE}",
    )
    names = ["seq", "query", "vector", "result", "dominant_cluster", "membership_vector"]
    return cache.CacheState(cache.assign_clusters(df, centres).select(*names), threshold=threshold)


def _queries(spark, centres, vectors):
    return cache.assign_clusters(vector_rows(spark, np.array(vectors), "seq", "vector", 100), centres)


def test_empty_cache_is_a_miss(spark, centres):
    found = cache.lookup(cache.empty_cache(spark).entries, _queries(spark, centres, [unit(1)]))
    row = found.first()
    assert row["cache_hit"] is False and row["score"] is None


def test_exact_match_hits_and_gives_the_result(spark, centres):
    state = _state(spark, centres, [(1, "hello world", unit(2))])
    found = cache.lookup(state.entries, _queries(spark, centres, [unit(2)]))
    assert found.first()["score"] > 0.999
    answer = cache.lookup_answers(found, state.entries).first()
    assert answer["matched_query"] == "hello world" and answer["result"][0]["text"] == "a document"
    assert answer["similarity_score"] == 1.0


def test_near_match_hits_at_070(spark, centres):
    near = unit(3) + 0.05 * unit(99)
    state = _state(spark, centres, [(1, "base", unit(3))])
    found = cache.lookup(state.entries, _queries(spark, centres, [near / np.linalg.norm(near)]), 0.70)
    assert found.first()["cache_hit"]


def test_orthogonal_vectors_in_one_bucket_miss(spark):
    one, other = np.eye(DIM)[0], np.eye(DIM)[8]
    bucket = F.lit(0).alias("dominant_cluster")
    entries = vector_rows(spark, one[None], "seq", "vector").select("*", bucket)
    queries = vector_rows(spark, other[None], "seq", "vector").select("*", bucket)
    row = cache.lookup(entries, queries, 0.80).first()
    assert row["score"] == 0.0 and not row["cache_hit"]


@pytest.mark.parametrize("limits", [{}, {"travel_rows": 0, "block_rows": 2}])
def test_only_the_own_bucket_is_compared_and_the_earliest_wins(spark, limits):
    v = unit_rows(1, 4)[0]
    rows = [(5, v, 0), (3, v, 1), (4, v, 1), (9, -v, 2)]
    entries = spark.createDataFrame(
        [(s, [float(x) for x in e], b) for s, e, b in rows],
        "seq bigint, vector array<float>, dominant_cluster int",
    )
    queries = spark.createDataFrame(
        [(100 + b, [float(x) for x in v], b) for b in range(4)],
        "seq bigint, vector array<float>, dominant_cluster int",
    )
    found = {r["seq"]: (r["entry_seq"], r["cache_hit"]) for r in cache.lookup(entries, queries, **limits).collect()}
    assert found == {100: (5, True), 101: (3, True), 102: (9, False), 103: (None, False)}


def test_row_threshold_overrides_the_default(spark, centres):
    state = _state(spark, centres, [(1, "base", unit(3))])
    near = unit(3) + 0.3 * unit(7)
    near = near / np.linalg.norm(near)
    queries = _queries(spark, centres, [near, near, near])
    own = F.when(F.col("seq") == 101, 0.9999).when(F.col("seq") == 102, 0.1)
    found = cache.lookup(state.entries, queries.withColumn("threshold", own), 0.9).orderBy("seq")
    assert [r["cache_hit"] for r in found.collect()] == [True, False, True]


def test_counters_and_rate(spark):
    state = cache.empty_cache(spark)
    first = state.stats().first().asDict()
    assert first == {"total_entries": 0, "hit_count": 0, "miss_count": 0, "hit_rate": 0.0, "threshold": 0.8}
    later = state.record(hits=3, misses=7).stats().first()
    assert later["hit_rate"] == pytest.approx(0.3)
    assert state.record(hits=2).hit_count == 2 and state.record(misses=1).miss_count == 1


def test_flush(spark, centres):
    state = _state(spark, centres, [(1, "flush test", unit(20))]).record(1, 1).flush()
    assert state.stats().first().asDict()["total_entries"] == 0
    assert (state.hit_count, state.miss_count) == (0, 0)


def test_snapshot_round_trip(spark, centres, tmp_path):
    path = str(tmp_path / "cache")
    state = _state(spark, centres, [(1, "persist test", unit(30))], threshold=0.85).record(hits=1)
    cache_store.save_snapshot(spark, state, path)
    loaded = cache_store.load_snapshot(spark, path, threshold=0.5)
    assert loaded.threshold == 0.85 and loaded.hit_count == 1
    assert sorted(loaded.entries.collect()) == sorted(state.entries.collect())
    cache_store.save_counters(spark, loaded.record(misses=4), path)
    again = cache_store.load_snapshot(spark, path)
    assert (again.hit_count, again.miss_count, again.entries.count()) == (1, 4, 1)
    cache_store.save_snapshot(spark, again.flush(), path)
    assert cache_store.load_snapshot(spark, path).entries.count() == 0


def test_missing_or_damaged_snapshot_is_an_empty_cache(spark, tmp_path):
    missing = cache_store.load_snapshot(spark, str(tmp_path / "none"), threshold=0.6)
    assert missing.entries.count() == 0 and missing.threshold == 0.6
    broken = tmp_path / "broken" / "counters"
    broken.mkdir(parents=True)
    (broken / "part-0.parquet").write_bytes(b"not a table")
    assert cache_store.load_snapshot(spark, str(tmp_path / "broken")).entries.count() == 0


def test_first_query_misses_then_hits(spark, centres):
    v = np.ones(DIM) / DIM**0.5
    log = log_rows(spark, [(1, "query", "nasa space shuttle", v, None, None), (2, "query", "nasa space shuttle", v, None, None)])
    played = replay.replay_log(log, centres)
    docs = vector_rows(spark, v[None], "doc_id").select(
        "*", F.lit("sci.space").alias("category"), F.lit(" Sample document. ").alias("text")
    )
    answers = replay.responses(played, replay.search_misses(played, docs)).orderBy("seq").collect()
    first, second = answers
    assert set(first.asDict()) == {
        "seq", "query", "cache_hit", "matched_query", "similarity_score", "result", "dominant_cluster"
    }
    assert first["cache_hit"] is False and first["matched_query"] is None and first["similarity_score"] is None
    assert second["cache_hit"] and second["matched_query"] == "nasa space shuttle"
    assert second["similarity_score"] >= 0.99 and second["result"] == first["result"]
    stats = replay.replay_stats(played).first()
    assert (stats["miss_count"], stats["hit_count"], stats["hit_rate"]) == (1, 1, 0.5)


def _log(n=160, seed=6, flush=(), own=(None, 0.3, 1.0)):
    vectors = unit_rows(n, seed)
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        if i in flush:
            rows.append((i, "flush", None, None, None, None))
            continue
        j = 3 if i % 3 == 0 else i  # a third of the log is one text
        limit = own[int(rng.integers(len(own)))]
        rows.append((i, "query", f"q{j}", vectors[j], limit, int(rng.integers(1, 21))))
    return rows


def _outcome(played):
    return {
        r["seq"]: (r["cache_hit"], r["source_seq"], r["matched_query"], r["era"])
        for r in played.decisions.collect()
    }


@pytest.mark.parametrize("chunk_rows", [1000, 37])
@pytest.mark.parametrize("flush", [(), (50, 51, 119)])
def test_replay_equals_serial_loop(spark, centres, chunk_rows, flush):
    rows = _log(flush=flush)
    played = replay.replay_log(
        log_rows(spark, rows).repartition(5), centres, threshold=0.5, chunk_rows=chunk_rows
    )
    assert _outcome(played) == serial_replay(rows, centres, 0.5)
    live = {r[0]: r[2] for r in rows}
    last = {s: o for s, o in _outcome(played).items() if o[3] == len(flush)}
    stats = replay.replay_stats(played).first()
    assert stats["hit_count"] == sum(o[0] for o in last.values())
    assert stats["total_entries"] == len({live[s] for s, o in last.items() if not o[0]})


@pytest.mark.parametrize("limits", [{}, {"travel_rows": 0, "block_rows": 10}])
@pytest.mark.parametrize("own", [(0.2, 0.3), (0.2, 0.3, 0.3, 0.3, 1.0)])
def test_rounds_grow_while_the_cache_answers(spark, centres, own, limits, monkeypatch):
    widths = []
    decided = replay._decided

    def counted(matched, **given):
        widths.append(matched.count())
        return decided(matched, **given)

    monkeypatch.setattr(replay, "_decided", counted)
    rows = _log(n=240, own=own, flush=(70,))
    played = replay.replay_log(log_rows(spark, rows), centres, threshold=0.5, chunk_rows=24, **limits)
    assert _outcome(played) == serial_replay(rows, centres, 0.5)
    assert widths and max(widths) > 24


@pytest.mark.parametrize("settle_rows", [0, 30])
def test_waiting_rows_settle_in_rounds(spark, centres, settle_rows, monkeypatch):
    monkeypatch.setattr(replay, "_SETTLE_ROWS", settle_rows)
    monkeypatch.setattr(replay, "_BLOCK", 7)
    rows = _log(flush=(50, 119))
    played = replay.replay_log(log_rows(spark, rows), centres, threshold=0.5)
    assert _outcome(played) == serial_replay(rows, centres, 0.5)


def test_a_chain_of_rows_each_like_the_one_before(spark):
    # Every second row opens; no other order of decisions gives that.
    angles = [0.3 * i for i in range(12)]
    rows = [(i, "query", f"q{i}", np.array([np.cos(a), np.sin(a)]), None, 5) for i, a in enumerate(angles)]
    played = replay.replay_log(log_rows(spark, rows), np.array([[0.0, 0.0]]), threshold=0.9)
    assert sorted(r["seq"] for r in played.decisions.filter("NOT cache_hit").collect()) == [0, 2, 4, 6, 8, 10]


@pytest.mark.parametrize("chunk_rows", [2, 37, 1000])
def test_entries_do_not_depend_on_chunks(spark, centres, chunk_rows):
    # Two texts with equal vectors: a text that is no best match still keeps its place.
    v, w = unit(5), unit(6)
    texts = ["a", "b", "b", "b", "c", "a", "d", "b", "c"]
    rows = [
        (i, "query", t, w if t in "cd" else v, None if i == 7 else 1.5, 5) for i, t in enumerate(texts)
    ]
    played = replay.replay_log(log_rows(spark, rows), centres, threshold=0.9, chunk_rows=chunk_rows)
    none = played.decisions.select("seq", F.lit(None).cast(cache.HIT_TYPE).alias("result")).limit(0)
    state = replay.state_after(played, none, centres)
    assert sorted((r["seq"], r["query"]) for r in state.entries.collect()) == [(0, "a"), (1, "b"), (4, "c"), (6, "d")]
    got = {r["seq"]: (r["cache_hit"], r["entry_seq"], r["source_seq"]) for r in played.decisions.collect()}
    assert got == {
        0: (False, 0, 0), 1: (False, 1, 1), 2: (False, 1, 2), 3: (False, 1, 3), 4: (False, 4, 4), 5: (False, 0, 5),
        6: (False, 6, 6), 7: (True, 0, 5), 8: (False, 4, 8),
    }


def test_no_documents_give_empty_results(spark, centres):
    docs = vector_rows(spark, unit_rows(3, 1), "doc_id").select(
        "*", F.lit("c").alias("category"), F.col("doc_id").cast("string").alias("text")
    )
    played = replay.replay_log(log_rows(spark, [(1, "query", "a", unit(1), None, 2)]), centres)
    answers = replay.responses(played, replay.search_misses(played, docs.limit(0)))
    assert [r["result"] for r in answers.collect()] == [[]]


def test_blocks_and_travel_give_the_same_replay(spark, centres):
    rows = _log()
    played = replay.replay_log(
        log_rows(spark, rows), centres, threshold=0.5, chunk_rows=40, travel_rows=0, block_rows=10
    )
    assert _outcome(played) == serial_replay(rows, centres, 0.5)


def test_replay_goes_on_from_a_state(spark, centres, tmp_path):
    rows = _log()
    whole = serial_replay(rows, centres, 0.5)
    docs = vector_rows(spark, unit_rows(30, 1), "doc_id").select(
        "*", F.lit("c").alias("category"), F.col("doc_id").cast("string").alias("text")
    )
    first = replay.replay_log(log_rows(spark, rows[:90]), centres, threshold=0.5)
    results = replay.search_misses(first, docs)
    path = str(tmp_path / "cache")
    cache_store.save_snapshot(spark, replay.state_after(first, results, centres), path)
    state = cache_store.load_snapshot(spark, path)
    second = replay.replay_log(log_rows(spark, rows[90:]), centres, state=state)
    hits = {r["seq"]: (r["cache_hit"], r["matched_query"]) for r in second.decisions.collect()}
    assert hits == {s: (o[0], o[2]) for s, o in whole.items() if s >= 90}
    stats = replay.replay_stats(second, state).first()
    assert stats["hit_count"] == sum(o[0] for o in whole.values())
    after = replay.state_after(second, replay.search_misses(second, docs), centres, state)
    assert after.stats().first() == stats
    answers = replay.responses(second, replay.search_misses(second, docs), state)
    assert answers.filter(F.col("result").isNull()).count() == 0


def test_a_hit_ignores_its_own_n_results(spark, centres):
    v = unit(1)
    docs = vector_rows(spark, unit_rows(30, 1), "doc_id").select(
        "*", F.lit("c").alias("category"), F.col("doc_id").cast("string").alias("text")
    )
    log = log_rows(spark, [(1, "query", "a", v, None, 2), (2, "query", "a", v, None, 9), (3, "query", "b", -v, None, 20)])
    played = replay.replay_log(log, centres)
    answers = replay.responses(played, replay.search_misses(played, docs)).orderBy("seq").collect()
    assert [len(r["result"]) for r in answers] == [2, 2, 20]


def test_empty_log(spark, centres):
    played = replay.replay_log(log_rows(spark, []), centres)
    assert played.decisions.count() == 0
    assert replay.replay_stats(played).first()["hit_rate"] == 0.0


def test_stream_equals_replay(spark, centres, tmp_path):
    rows = _log(flush=(50, 119))
    docs = vector_rows(spark, unit_rows(30, 1), "doc_id").select(
        "*", F.lit("c").alias("category"), F.col("doc_id").cast("string").alias("text")
    )
    played = replay.replay_log(log_rows(spark, rows), centres, threshold=0.5)
    expected = replay.responses(played, replay.search_misses(played, docs))

    stream = QueryStream(spark, str(tmp_path / "state"), centres, docs, threshold=0.5, fanout=2)
    source = str(tmp_path / "log")
    for part in (rows[:60], rows[60:110], rows[110:]):
        log_rows(spark, part).coalesce(1).write.mode("append").parquet(source)
        # Each run picks up where the last one stopped.
        log = spark.readStream.schema(LOG_SCHEMA).parquet(source)
        run = stream.start(log, str(tmp_path / "progress")).trigger(availableNow=True).start()
        run.awaitTermination()
    got = stream.responses()
    assert sorted(got.collect()) == sorted(expected.select(*got.columns).collect())

    # A batch out of order is refused, an invalid request set aside.
    with pytest.raises(ValueError, match="begins at seq"):
        stream.answer_batch(log_rows(spark, rows[:5]), 3)
    stream.answer_batch(log_rows(spark, [(900, "query", "", unit(1), None, 5), (901, "query", "x", unit(1), 2.0, 5)]), 3)
    assert {r["seq"] for r in stream.rejected().collect()} == {900, 901}
    # Running an earlier batch again changes nothing.
    stream.answer_batch(log_rows(spark, rows[110:]), 2)
    assert sorted(stream.responses().collect()) == sorted(expected.select(*got.columns).collect())


def test_segments_of_entries(spark, centres, tmp_path):
    rng = np.random.default_rng(5)
    stream = QueryStream(spark, str(tmp_path / "a"), centres, spark.range(0), fanout=3)
    twin = QueryStream(spark, str(tmp_path / "b"), centres, spark.range(0), fanout=3)
    kept, era = {}, 0
    for batch in range(20):
        segments = stream.segments_before(batch)
        covered = [b for level, first in segments for b in range(first, first + 3**level)]
        assert covered == list(range(batch)) and len(segments) <= 2 * 3
        rows = []
        for i in range(4):
            written = batch * 10 + i
            if batch in (8, 13) and i == 2:
                era, kept = era + 1, {}
            # Now and then an older entry of the era is written again.
            seq = int(rng.choice(sorted(kept))) if kept and rng.random() < 0.5 else written
            kept[seq] = str(written)
            rows.append((seq, f"q{seq}", [0.5], [(1, "c", 0.5, str(written))], 0, None, written, era))
        segment = spark.createDataFrame(rows, query_stream._ENTRIES).coalesce(1)
        stream._write_segment(segment, 0, batch)
        stream._compact(batch, era)
        if batch != 2:  # the batch that would fill segments is never run here
            twin._write_segment(segment, 0, batch)
        if batch in (0, 7, 8, 9, 14, 17, 19):
            found = stream.entries_before(batch + 1, era).collect()
            assert {r["seq"]: r["result"][0]["text"] for r in found} == kept and len(found) == len(kept)
            assert all(r["query"] == f"q{r['seq']}" for r in found)
    assert Path(stream._segment(2, 0)).exists() and not Path(twin._segment(2, 0)).exists()
    assert sorted(twin.entries_before(20, era).collect()) == sorted(stream.entries_before(20, era).collect())
    plan = stream.entries_before(20, era)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(era" in plan
    with pytest.raises(ValueError, match="fanout"):
        QueryStream(spark, str(tmp_path), centres, spark.range(0), fanout=1)


def test_requests(spark):
    rows = [
        (1, "ok", None, None), (2, "", 0.5, 5), (3, None, 0.5, 5), (4, "x", -0.1, 5), (5, "x", 1.1, 5),
        (6, "x", 0.0, 1), (7, "x", 1.0, 20), (8, "x", 0.5, 0), (9, "x", 0.5, 21), (10, "x", float("nan"), 5),
    ]
    df = spark.createDataFrame(rows, "seq int, query string, threshold double, n_results int")
    valid, rejected = requests.split_requests(df)
    assert {r["seq"]: r["n_results"] for r in valid.collect()} == {1: 5, 6: 1, 7: 20}
    reasons = {r["seq"]: r["reason"].split(":")[0] for r in rejected.collect()}
    assert reasons == {
        2: "query", 3: "query", 4: "threshold", 5: "threshold", 8: "n_results", 9: "n_results", 10: "threshold"
    }


def test_threshold_sweep_and_reports(spark, centres):
    base = unit(3)
    tests = [base, *(base + w * unit(50 + i) for i, w in enumerate((0.1, 0.5, 1.0)))]
    tests = np.array([t / np.linalg.norm(t) for t in tests])
    entries = _state(spark, centres, [(1, "base", base)]).entries
    queries = cache.assign_clusters(vector_rows(spark, tests, "seq", "vector"), centres)
    swept = thresholds.threshold_sweep(entries, queries)
    cluster = lambda v: int(np.argmin(np.linalg.norm(centres - v, axis=1)))
    expected = {
        (i, t): "HIT" if cluster(v) == cluster(base) and round(float(v @ base), 6) >= t else "MISS"
        for i, v in enumerate(tests)
        for t in thresholds.THRESHOLDS
    }
    assert {(r["seq"], r["threshold"]): r["outcome"] for r in swept.collect()} == expected
    labelled = queries.withColumn("label", F.lit("case"))
    report = thresholds.similarity_to(entries, labelled).orderBy("seq").collect()
    assert [r["similarity"] for r in report] == pytest.approx((tests @ base).tolist(), abs=1e-3)
    assert report[0]["label"] == "case"
    with pytest.raises(ValueError):
        thresholds.similarity_to(entries.limit(0), labelled)


def test_health(spark, centres):
    entries = _state(spark, centres, [(1, "a", unit(1)), (2, "b", unit(2))]).entries
    docs = spark.range(100)
    table = spark.createDataFrame([(i, [0.0]) for i in range(4)], "cluster int, centre array<double>")
    assert cache.health(docs, table, entries).first().asDict() == {
        "status": "healthy", "indexed_documents": 100, "n_clusters": 4, "cached_queries": 2
    }
