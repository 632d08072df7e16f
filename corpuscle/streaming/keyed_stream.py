"""The semantic cache as keyed state: one state per bucket, kept by Spark's state store.

A request only meets entries of its own cluster, so the cluster is the key of
the state: its entries since the last flush. A flush goes to every key. Spark
carries the states from batch to batch, checkpoints them with the progress of
the stream and restores them after a restart; no earlier batch's files are read
again, and a batch touches only the states of the buckets it has requests for.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from corpuscle.functions import membership as mb
from corpuscle.functions.vectors import SCORE_DIGITS
from corpuscle.operators.cache import DEFAULT_THRESHOLD, assign_clusters
from corpuscle.operators.search import DEFAULT_RESULTS

DECISIONS = (
    "seq bigint, query string, n_results int, cache_hit boolean, entry_seq bigint, source_seq bigint, "
    "matched_query string, score double, vector array<float>, era bigint, dominant_cluster int"
)
# The entries of a bucket as one Arrow table, its flushes so far, and the last request it has seen.
_STATE = "entries binary, flushes bigint, last_seq bigint"
_ENTRIES = pa.schema([("seq", pa.int64()), ("latest", pa.int64()), ("query", pa.string()), ("vector", pa.list_(pa.float32()))])


class _Entries:
    """Live entries of a bucket in the order of their places."""

    def __init__(self, stored: bytes | None = None):
        table = pa.ipc.open_stream(stored).read_all() if stored else _ENTRIES.empty_table()
        self.seq: list[int] = table["seq"].to_pylist()
        self.latest: list[int] = table["latest"].to_pylist()
        self.query: list[str] = table["query"].to_pylist()
        self.place = {text: i for i, text in enumerate(self.query)}
        self.held = [np.asarray(v, dtype=np.float32) for v in table["vector"].to_pylist()]
        self.matrix = np.array(self.held, dtype=np.float64)

    def stored(self) -> bytes:
        columns = [pa.array(c, f.type) for c, f in zip((self.seq, self.latest, self.query, self.held), _ENTRIES, strict=True)]
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, _ENTRIES) as writer:
            writer.write_table(pa.Table.from_arrays(columns, schema=_ENTRIES))
        return sink.getvalue().to_pybytes()

    def best(self, vector: np.ndarray) -> tuple[float, int] | None:
        """Score and place of the closest entry, the earliest on ties."""
        if not self.held:
            return None
        if len(self.matrix) < len(self.held):
            # Room for as many again, so that a batch of misses copies each entry a few times only.
            grown = np.full((2 * len(self.held), len(vector)), np.nan)
            grown[: len(self.held)] = self.held
            self.matrix = grown
        scores = np.round(self.matrix[: len(self.held)] @ vector, SCORE_DIGITS)
        at = int(scores.argmax())
        return float(scores[at]), at

    def write(self, seq: int, query: str, vector: np.ndarray) -> int:
        """A miss: the text keeps the place it has, else it gets one."""
        if query in self.place:
            at = self.place[query]
            self.latest[at] = seq
            return self.seq[at]
        at = self.place[query] = len(self.held)
        self.seq.append(seq)
        self.latest.append(seq)
        self.query.append(query)
        self.held.append(vector.astype(np.float32))
        if at < len(self.matrix):
            self.matrix[at] = vector
        return seq


def _play(key: tuple[Any, ...], batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    (bucket,) = key
    stored, flushes, last = state.get if state.exists else (None, 0, None)
    entries = _Entries(stored)
    rows = pd.concat(list(batches)).sort_values("seq", kind="stable")
    if last is not None and len(rows) and rows["seq"].iloc[0] <= last:
        raise ValueError(f"a batch begins at seq {rows['seq'].iloc[0]}, after seq {last} was answered")
    out = []
    for row in rows.itertuples(index=False):
        last = int(row.seq)
        if row.op == "flush":
            entries, flushes = _Entries(), flushes + 1
            continue
        vector = np.asarray(row.vector, dtype=np.float64)
        found = entries.best(vector)
        common = (last, row.query, int(row.n_results))
        if found is not None and found[0] >= row.threshold:
            score, at = found
            answer = (True, entries.seq[at], entries.latest[at], entries.query[at], score, None)
        else:
            answer = (False, entries.write(last, row.query, vector), last, None, None, row.vector)
        out.append((*common, *answer, flushes, int(bucket)))
    state.update((entries.stored(), flushes, last))
    names = [field.split()[0] for field in DECISIONS.split(", ")]
    yield pd.DataFrame(out, columns=names)


def keyed_decisions(
    log: DataFrame, centres: np.ndarray, threshold: float = DEFAULT_THRESHOLD, fuzziness: float = mb.FUZZINESS
) -> DataFrame:
    """Hit or miss of every query of a streaming ``log``, as of ``replay_log``.

    ``log`` has ``seq, op, query, vector, threshold, n_results``; batches come in
    order of ``seq`` (else the batch raises), inside a batch any order will do.
    Append the rows to a sink; ``era`` counts the flushes before a row. A bucket
    with many requests is one task of a batch, in which they have to be decided
    in order; a bucket's state holds its live entries.
    """
    buckets = F.array(*[F.lit(i) for i in range(len(centres))])
    columns = ["seq", "op", "query", "vector", "threshold", "n_results", "bucket"]
    rows = log.select(
        "seq",
        "op",
        "query",
        F.col("vector").cast("array<float>").alias("vector"),
        F.coalesce(F.col("threshold").cast("double"), F.lit(float(threshold))).alias("threshold"),
        F.coalesce(F.col("n_results").cast("int"), F.lit(DEFAULT_RESULTS)).alias("n_results"),
    )
    queries = assign_clusters(rows.filter("op = 'query'"), centres, fuzziness=fuzziness)
    queries = queries.withColumn("bucket", F.col("dominant_cluster").cast("int")).select(*columns)
    flushes = rows.filter("op = 'flush'").withColumn("bucket", F.explode(buckets)).select(*columns)
    return (
        queries.unionByName(flushes)
        .groupBy("bucket")
        .applyInPandasWithState(_play, DECISIONS, _STATE, "append", GroupStateTimeout.NoTimeout)
    )
