"""The query flow as a stream: every micro-batch is a chunk of the replay.

What the cache knows lives in tables under one root folder, one sub-folder per
micro-batch, so state is as large as storage, is looked up in parallel and
outlives the driver. A micro-batch that is run again after a failure reads only
folders of earlier batches and overwrites its own: its answers stay the same.

Entries lie in segments. A batch writes a segment of level 0; whenever
``fanout`` segments of a level are full, the batch that fills them merges their
live rows into one of the next level. Segments are numbered by batch, so which
ones cover the batches before a given one follows from its number: fewer than
``fanout`` of each level, and a row is rewritten once a level. Inside a segment
rows lie by era, so what a flush has dropped is never read again.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from corpuscle.functions import membership as mb
from corpuscle.operators.cache import DEFAULT_THRESHOLD, ENTRY_SCHEMA, HIT_TYPE, CacheState
from corpuscle.operators.replay import (
    CHUNK_ROWS,
    replay_log,
    responses,
    search_misses,
)
from corpuscle.operators.requests import split_requests
from corpuscle.sources.shared import materialise

LOG_SCHEMA = (
    "seq bigint, op string, query string, vector array<float>, threshold double, n_results int"
)
RESPONSE_SCHEMA = (
    "seq bigint, query string, cache_hit boolean, matched_query string, "
    f"similarity_score double, result {HIT_TYPE}, dominant_cluster int"
)
_ERAS = "batch bigint, flushes bigint, last_seq bigint"
_REJECTED = "seq bigint, query string, threshold double, n_results int, reason string, batch bigint"
_ENTRIES = ENTRY_SCHEMA + ", written bigint, era bigint"
# Segments of a level that are merged into one of the next.
FANOUT = 8


@dataclass(frozen=True)
class QueryStream:
    """Where a stream keeps its state, and what it answers from."""

    spark: SparkSession
    root: str
    centres: np.ndarray
    documents: DataFrame
    threshold: float = DEFAULT_THRESHOLD
    fuzziness: float = mb.FUZZINESS
    chunk_rows: int = CHUNK_ROWS
    fanout: int = FANOUT

    def __post_init__(self) -> None:
        if self.fanout < 2:
            raise ValueError("fanout must be at least 2")

    def start(self, log: DataFrame, checkpoint: str) -> DataStreamWriter:
        """A writer for a streaming ``log``; call ``.start()`` on it, with a trigger if wanted."""
        return log.writeStream.foreachBatch(self.answer_batch).option(
            "checkpointLocation", checkpoint
        )

    def answer_batch(self, log: DataFrame, batch: int) -> None:
        """Replay one batch; requests that aren't valid are set aside.

        Batches come in order of ``seq``: one that begins before an earlier batch ended raises.
        """
        log = materialise(log, "stream-batch")  # the batch is read several times
        era, last_seq = self._before(batch)
        ends = log.agg(F.min("seq").alias("first"), F.max("seq").alias("last")).first()
        if last_seq is not None and ends["first"] is not None and ends["first"] <= last_seq:
            raise ValueError(f"batch {batch} begins at seq {ends['first']}, after seq {last_seq} was answered")
        valid, rejected = split_requests(log.filter(F.col("op") == "query"))
        rejected.select("seq", "query", "threshold", "n_results", "reason").write.mode("overwrite").parquet(
            f"{self.root}/rejected/batch={batch}"
        )
        log = log.filter(F.col("op") == "flush").unionByName(valid.select(*log.columns))
        state = CacheState(self.entries_before(batch, era), threshold=self.threshold)
        replay = replay_log(
            log,
            self.centres,
            state=state,
            fuzziness=self.fuzziness,
            chunk_rows=self.chunk_rows,
        )
        results = materialise(search_misses(replay, self.documents), "stream-results")
        # ``seq`` is the place of the entry, ``written`` the request that wrote it.
        misses = replay.decisions.filter(~F.col("cache_hit")).join(results, "seq", "left")
        entries = misses.select(
            F.col("entry_seq").alias("seq"),
            "query",
            "vector",
            F.col("result").cast(HIT_TYPE).alias("result"),
            "dominant_cluster",
            F.lit(None).cast("array<double>").alias("membership_vector"),
            (F.col("era") + era).alias("era"),
            F.col("seq").alias("written"),
        )
        answers = responses(replay, results, state)
        answers.write.mode("overwrite").parquet(f"{self.root}/responses/batch={batch}")
        self._write_segment(entries, 0, batch)
        self._compact(batch, era + replay.flushes)
        last = ends["last"] if ends["last"] is not None else last_seq
        # Counted from the start, so that one folder is enough to go on from.
        self.spark.createDataFrame([(era + replay.flushes, last)], "flushes bigint, last_seq bigint").coalesce(1).write.mode(
            "overwrite"
        ).parquet(f"{self.root}/eras/batch={batch}")

    def responses(self) -> DataFrame:
        """All answers so far."""
        return self._read("responses", RESPONSE_SCHEMA + ", batch bigint").drop("batch")

    def rejected(self) -> DataFrame:
        """All requests that weren't answered, with the reason."""
        return self._read("rejected", _REJECTED).drop("batch")

    def _read(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def _before(self, batch: int) -> tuple[int, int | None]:
        """Flushes of the earlier batches, and the last ``seq`` they answered."""
        try:
            earlier = self.spark.read.schema("flushes bigint, last_seq bigint").parquet(f"{self.root}/eras/batch={batch - 1}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            # The numbers of batches may have a gap, as after a stream that was started anew.
            earlier = self._read("eras", _ERAS).filter(F.col("batch") < batch)
        row = earlier.agg(F.coalesce(F.max("flushes"), F.lit(0)).alias("n"), F.max("last_seq").alias("last")).first()
        return row["n"], row["last"]

    def _segment(self, level: int, first: int) -> str:
        """The folder of the segment whose first batch is ``first``."""
        return f"{self.root}/entries/level={level}/first={first}"

    def _write_segment(self, rows: DataFrame, level: int, first: int) -> None:
        rows.write.mode("overwrite").partitionBy("era").parquet(self._segment(level, first))

    def segments_before(self, batch: int) -> list[tuple[int, int]]:
        """``(level, first batch)`` of the segments that cover all batches before ``batch``."""
        found, first, level = [], batch, 0
        while first:
            size = self.fanout**level
            while first % (size * self.fanout):
                first -= size
                found.append((level, first))
            level += 1
        return found[::-1]

    def _rows(self, segments: list[tuple[int, int]], era: int) -> DataFrame:
        """Rows of an era in some segments."""
        parts = [part for level, first in segments for part in self._parts(level, first)]
        if not parts:
            return self.spark.createDataFrame([], _ENTRIES)
        return reduce(DataFrame.unionByName, parts).filter(F.col("era") == era)

    def _parts(self, level: int, first: int) -> list[DataFrame]:
        """A segment, or what it would have been merged from if the batch that fills it has not been."""
        try:
            return [self.spark.read.schema(_ENTRIES).parquet(self._segment(level, first))]
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
        size = self.fanout ** (level - 1) if level else 0
        return [part for i in range(self.fanout if level else 0) for part in self._parts(level - 1, first + i * size)]

    def _compact(self, batch: int, era: int) -> None:
        """Merge the segments that ``batch`` makes full, level by level."""
        level, end = 0, batch + 1
        while end % self.fanout ** (level + 1) == 0:
            size = self.fanout**level
            first = end - size * self.fanout
            full = [(level, at) for at in range(first, end, size)]
            level += 1
            self._write_segment(_merged(self._rows(full, era)), level, first)

    def entries_before(self, batch: int, era: int) -> DataFrame:
        """Live entries of all batches before ``batch``, each with the answer written last."""
        live = _merged(self._rows(self.segments_before(batch), era))
        return live.select("seq", "query", "vector", "result", "dominant_cluster", "membership_vector")


def _merged(rows: DataFrame) -> DataFrame:
    """One row per entry: what its first row says, with the result of its last.

    Only a text missed again is written twice. If an entry's first row isn't among
    ``rows``, its last one stays as it is, for a later merge.
    """
    places = rows.withColumn("_first", F.col("written") == F.col("seq"))
    again = (
        places.filter(~F.col("_first"))
        .groupBy("seq")
        .agg(F.max_by(F.struct(*rows.columns), "written").alias("_again"))
    )
    first = places.filter("_first").select(F.struct(*rows.columns).alias("_row"), "seq")
    both = first.join(again, "seq", "full")
    return both.select(
        *[
            F.coalesce("_again.result", "_row.result").alias("result") if c == "result" else F.coalesce(f"_row.{c}", f"_again.{c}").alias(c)
            for c in rows.columns
        ]
    )
