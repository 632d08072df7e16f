"""The cache as keyed state against the replay of the whole log."""

import numpy as np
import pytest

from corpuscle.operators import replay
from corpuscle.streaming.keyed_stream import DECISIONS, keyed_decisions
from corpuscle.streaming.query_stream import LOG_SCHEMA
from pyspark.errors import StreamingQueryException

from support import DIM, log_rows, unit_rows


def _rows():
    vectors = unit_rows(120, 6)
    rng = np.random.default_rng(6)
    rows = []
    for i in range(120):
        if i in (50, 51, 89):
            rows.append((i, "flush", None, None, None, None))
            continue
        j = 3 if i % 3 == 0 else i
        rows.append((i, "query", f"q{j}", vectors[j], [None, 0.3, 1.5][int(rng.integers(3))], int(rng.integers(1, 21))))
    return rows


def _run(spark, source, root, centres):
    log = spark.readStream.schema(LOG_SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    out = keyed_decisions(log, centres, 0.5).writeStream.format("parquet").option("path", f"{root}/decisions")
    running = out.option("checkpointLocation", f"{root}/progress").trigger(availableNow=True).start()
    running.awaitTermination()
    return sum(1 for p in running.recentProgress if p.numInputRows)


def test_batches_and_a_restart_equal_the_replay(spark, tmp_path):
    centres = np.eye(3, DIM)
    rows = _rows()
    source, batches = str(tmp_path / "log"), 0
    for half in (rows[:60], rows[60:]):
        for start in range(0, 60, 15):
            log_rows(spark, half[start : start + 15]).coalesce(1).write.mode("append").parquet(source)
        # The second run finds the states of the first.
        batches += _run(spark, source, tmp_path, centres)
    assert batches == 8
    got = spark.read.schema(DECISIONS).parquet(str(tmp_path / "decisions"))
    expected = replay.replay_log(log_rows(spark, rows), centres, threshold=0.5).decisions
    assert sorted(map(repr, got.collect())) == sorted(map(repr, expected.select(*got.columns).collect()))
    # A batch out of order is refused.
    log_rows(spark, rows[5:9]).coalesce(1).write.mode("append").parquet(source)
    with pytest.raises(StreamingQueryException, match="begins at seq"):
        _run(spark, source, tmp_path, centres)
