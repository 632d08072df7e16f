"""Best matches by inner product: the join behind search and cache lookup.

For every query row, find the ``n`` entries with the largest inner product,
optionally only among entries of the query's own bucket. Scores come from
matrix products on Arrow batches, and only the best ``n`` leave a task, so no
pair is ever written out. Which side travels is decided by counting:

* few queries: they go to every task that scans entries; each task keeps its
  best ``n`` per query, and one shuffle of those merges them;
* few entries: they go to every task that scans queries; no shuffle at all;
* many of both: each bucket is cut into entry blocks and query blocks by the
  hash of the row's id, and each pair of blocks is one group. A row travels once
  per block of the other side, so a bucket is cut into no more blocks than give
  every core some groups: with larger tables blocks get longer, up to
  ``BLOCK_BYTES``, not more. A bucket with a third of all rows has more blocks;
* more than that: one side travels in pieces of ``BLOCK_BYTES``, one after another, and
  the other is scanned for each. Shuffled are only the best ``n``, not vectors, which
  as blocks would go round once per block of the other side: the square of the tables.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf
from pyspark.sql.pandas.types import to_arrow_schema

from corpuscle.functions.vectors import SCORE_DIGITS, stored_matrix
from corpuscle.sources.shared import discard, fresh_path, small_side

# A side travels to every task only below both limits.
TRAVEL_ROWS = 20_000
TRAVEL_BYTES = 256 * 1024 * 1024
# Rows per block where both sides are large, at least; and the bytes a block may grow to.
BLOCK_ROWS = 20_000
BLOCK_BYTES = 32 * 1024 * 1024
GROUPS_PER_CORE = 4
# Size of one matrix product: small enough to stay in a core's cache.
_BLOCK_QUERIES, _BLOCK_ENTRIES = 512, 1024
# A block with more candidates than one in so many cells is done in doubles at once.
_FEW_CELLS = 128
# Scores are compared as whole multiples of the last digit that counts.
_UNITS = 10.0**SCORE_DIGITS


@dataclass
class _Rows:
    """One side of a match in memory, in order of the id: ids, vectors as they are stored, rows per bucket,
    and the largest length of a vector (infinite if they aren't stored in single precision)."""

    ids: np.ndarray
    vectors: np.ndarray
    by_bucket: dict[int, np.ndarray]
    length: float = np.inf

    @classmethod
    def of(cls, table: pa.Table | pa.RecordBatch, id_column: str) -> _Rows:
        if not len(table):
            return cls(np.array([]), np.zeros((0, 0)), {})
        ids = table[id_column].to_numpy(zero_copy_only=False)
        buckets = table["bucket"].to_numpy(zero_copy_only=False)
        order = np.argsort(ids, kind="stable")
        by_bucket = {b: order[buckets[order] == b] for b in np.unique(buckets)}
        vectors = stored_matrix(table["vector"])
        return cls(ids, vectors, by_bucket, _longest(vectors) if vectors.dtype == np.float32 else np.inf)

    def part(self, rows: np.ndarray) -> np.ndarray:
        """Some vectors as doubles. Only parts are widened, never a whole side."""
        return self.vectors[rows].astype(np.float64, copy=False)


def _longest(vectors: np.ndarray) -> float:
    """The largest length of a vector."""
    parts = (vectors[i : i + _BLOCK_ENTRIES].astype(np.float64) for i in range(0, len(vectors), _BLOCK_ENTRIES))
    return math.sqrt(np.max([np.einsum("ij,ij->i", part, part).max() for part in parts]))


def _slack(queries: _Rows, entries: _Rows) -> float | None:
    """How far a product in single precision is from the exact one, at most; None if that says nothing.

    Whatever the order of summation, the error of an inner product is below its number of
    terms times the unit roundoff (2**-24) times the lengths; this is twice that.
    """
    reach = queries.length * entries.length
    return (queries.vectors.shape[1] + 2) * 2.0**-23 * reach if reach < 1e30 else None


def _best(found: pd.DataFrame, n: int) -> pd.DataFrame:
    """The best ``n`` rows of each query, best first."""
    ranked = found.sort_values(
        ["query", "score", "entry"], ascending=[True, False, True], kind="stable"
    )
    return ranked.groupby("query", sort=False).head(n)


def _largest(scores: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Mask of the n largest cells of each row, the leftmost among equals; and the n-th values.

    Every row has more than n cells above minus infinity.
    """
    at = scores.shape[1] - n
    nth = np.partition(scores, at, axis=1)[:, at]
    mask = scores > nth[:, None]
    tied = scores == nth[:, None]
    wanted = n - mask.sum(axis=1)
    crowded = np.flatnonzero(tied.sum(axis=1) > wanted)
    if len(crowded):
        tied[crowded] &= np.cumsum(tied[crowded], axis=1) <= wanted[crowded, None]
    return mask | tied, nth


def _in_units(products: np.ndarray) -> np.ndarray:
    """Scores as whole multiples of the last digit that counts, in place."""
    products *= _UNITS
    return np.rint(products, out=products)


def _candidates(
    block: np.ndarray, part: np.ndarray, floor: np.ndarray, slack: float | None
) -> tuple[np.ndarray, np.ndarray] | None:
    """Cells that may be above the floor, by products in single precision; None if those are many."""
    if slack is None or np.count_nonzero(floor == -np.inf) * _FEW_CELLS > len(floor):
        return None
    cut = np.nextafter((floor / _UNITS - slack).astype(np.float32), np.float32(-np.inf))
    near = block @ part.T >= cut[:, None]
    if np.count_nonzero(near) * _FEW_CELLS > near.size:
        return None
    return np.divmod(np.flatnonzero(near), len(part))


def _best_pairs(
    queries: _Rows, in_q: np.ndarray, entries: _Rows, in_e: np.ndarray, n: int, earlier: bool, least: np.ndarray | None
) -> Iterator[tuple]:
    """(query row, entry row, score): a superset of the n best of each query, n per block.

    Only the rows ``in_q`` and ``in_e`` of both sides count. Entries come in
    order of their id, so an entry of a later block must beat the n-th best so
    far; an equal score is not enough. With ``earlier``, entries not before the
    query are left out. ``least`` has, per query row, the score in units below
    which no entry counts. Most cells are told to be too low by a product in
    single precision and its largest error; scores are from doubles.
    """
    slack = _slack(queries, entries)
    for start in range(0, len(in_q), _BLOCK_QUERIES):
        of_queries = in_q[start : start + _BLOCK_QUERIES]
        floor = np.full(len(of_queries), -np.inf) if least is None else least[of_queries]
        for first in range(0, len(in_e), _BLOCK_ENTRIES):
            of_entries = in_e[first : first + _BLOCK_ENTRIES]
            candidates = _candidates(queries.vectors[of_queries], entries.vectors[of_entries], floor, slack)
            if candidates is None:
                scores = _in_units(queries.part(of_queries) @ entries.part(of_entries).T)
                if earlier:
                    late = entries.ids[of_entries] >= queries.ids[of_queries, None]
                    scores[late] = -np.inf
                above = scores > floor[:, None]
                full = np.flatnonzero(above.sum(axis=1) > n)  # more than n cells: only the largest stay
                if len(full):
                    above[full], floor[full] = _largest(scores[full], n)
                rows, columns = np.nonzero(above)
                scores = scores[rows, columns]
            else:
                rows, columns = candidates
                pairs = queries.part(of_queries[rows]), entries.part(of_entries[columns])
                scores = _in_units(np.einsum("ij,ij->i", *pairs))
                above = scores > floor[rows]
                if earlier:
                    above &= entries.ids[of_entries[columns]] < queries.ids[of_queries[rows]]
                rows, columns, scores = rows[above], columns[above], scores[above]
                full = np.flatnonzero(np.bincount(rows, minlength=len(of_queries)) > n)
                if len(full):
                    in_full = np.isin(rows, full)
                    at = np.searchsorted(full, rows[in_full]), columns[in_full]
                    cells = np.full((len(full), len(of_entries)), -np.inf)
                    cells[at] = scores[in_full]
                    largest, floor[full] = _largest(cells, n)
                    stay = ~in_full
                    stay[in_full] = largest[at]
                    rows, columns, scores = rows[stay], columns[stay], scores[stay]
            yield of_queries[rows], of_entries[columns], scores / _UNITS


def _match(
    queries: _Rows, entries: _Rows, n: int, earlier: bool, least: np.ndarray | None = None
) -> pd.DataFrame:
    """Best ``n`` entries per query, over all buckets the query is in; ``least`` as in ``_best_pairs``."""
    parts = []
    for bucket, in_q in queries.by_bucket.items():
        in_e = entries.by_bucket.get(bucket)
        if in_e is None:
            continue
        for rows, columns, scores in _best_pairs(queries, in_q, entries, in_e, n, earlier, least):
            found = pd.DataFrame(
                {"query": queries.ids[rows], "entry": entries.ids[columns], "score": scores}
            )
            parts.append(found)
    if not parts:
        return pd.DataFrame({"query": [], "entry": [], "score": []})
    return _best(pd.concat(parts, ignore_index=True), n)


def _side(df: DataFrame, name: str, id_column: str, vector: str, bucket: str | None) -> DataFrame:
    return df.select(
        F.col(id_column).alias(name),
        (F.lit(0) if bucket is None else F.col(bucket)).cast("bigint").alias("bucket"),
        F.col(vector).alias("vector"),
    )


def _travelling(side: DataFrame, count: int, limit: int) -> pa.Table | None:
    """The side as one Arrow table if it is small enough, else None."""
    if count > limit:
        return None
    width = side.agg(F.max(F.size("vector")).alias("width")).first()["width"] or 0
    if count * width * 8 > TRAVEL_BYTES:
        return None
    return side.toArrow()


def top_matches(
    entries: DataFrame,
    queries: DataFrame,
    n: int,
    *,
    entry_id: str,
    query_id: str,
    entry_vector: str = "embedding",
    query_vector: str = "embedding",
    bucket: str | None = None,
    several_buckets: bool = False,
    earlier: bool = False,
    travel_rows: int = TRAVEL_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Rows ``query, entry, score, rank``: the ``n`` best entries of each query.

    ``rank`` counts from 1; equal scores are ordered by entry id. With
    ``bucket`` (a BIGINT column of both sides) only entries of the query's
    bucket count, and a query whose bucket is empty has no row. With
    ``several_buckets`` a query may be given once per bucket it visits. With
    ``earlier`` only entries whose id is below the query's id count. Blocks
    have ``block_rows`` rows until there are enough of them; then they get longer.
    Where a bucket would need more of the longest ones, a side travels in pieces;
    that runs at once, and both sides and the best matches of each piece are written.
    """
    e = _side(entries, "entry", entry_id, entry_vector, bucket)
    q = _side(queries, "query", query_id, query_vector, bucket)
    schema = T.StructType(
        [
            T.StructField("query", q.schema["query"].dataType),
            T.StructField("entry", e.schema["entry"].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )

    n_queries = q.count()
    few_queries = _travelling(q, n_queries, travel_rows)
    if few_queries is not None:
        return _ranked(e.mapInArrow(_scan_entries(few_queries, n, earlier), schema), n)
    n_entries = e.count()
    few_entries = _travelling(e, n_entries, travel_rows)
    if few_entries is not None:
        # A query row meets all entries in one task, so its ranks are final there.
        ranked = T.StructType(schema.fields + [T.StructField("rank", T.IntegerType())])
        found = q.mapInArrow(_scan_queries(few_entries, n, earlier), ranked)
        return _ranked(found, n) if several_buckets else found
    # Smaller blocks where full ones would not give every core some groups.
    cores = entries.sparkSession.sparkContext.defaultParallelism
    even = math.isqrt(n_queries * n_entries // (GROUPS_PER_CORE * cores))
    block_rows = min(block_rows, max(even, 1000))
    # A row travels once per block of the other side, so their number must not follow the rows.
    most = max(2, math.isqrt(GROUPS_PER_CORE * cores))
    width = q.agg(F.max(F.size("vector")).alias("width")).first()["width"] or 1
    longest = max(block_rows, BLOCK_BYTES // (4 * max(width, 1)))
    if _crowded(q, n_queries, most * longest) or _crowded(e, n_entries, most * longest):
        few_blocks = n_entries <= n_queries and n_entries <= most * longest
        count = n_entries if few_blocks else n_queries
        return _ranked(_in_pieces(e, q, n, earlier, schema, -(-count // longest), few_blocks), n)
    return _ranked(_block_pairs(e, q, n, earlier, schema, block_rows, most, longest), n)


def match_in_place(
    entries: DataFrame,
    *,
    entry_id: str,
    vector: str = "vector",
    bucket: str | None = None,
    travel_rows: int = TRAVEL_ROWS,
) -> Callable[[Column, Column], Column] | None:
    """Column function ``(bucket, vector) -> struct<entry, score>``: the best entry of a row.

    Null where the bucket has no entry. The rows themselves stay in the JVM, and
    nothing is shuffled. None if the entries are too many to travel.
    """
    e = _side(entries, "entry", entry_id, vector, bucket)
    travelling = _travelling(e, e.count(), travel_rows)
    if travelling is None:
        return None
    held: list[_Rows] = []

    @arrow_udf("struct<entry: bigint, score: double>")
    def best(bucket: pa.Array, vector: pa.Array) -> pa.Array:
        if not held:
            held.append(_Rows.of(travelling, "entry"))
        rows = np.arange(len(vector))
        queries = _Rows.of(pa.table({"id": rows, "bucket": bucket, "vector": vector}), "id")
        found = _match(queries, held[0], 1, False)
        at = found["query"].to_numpy(dtype=np.int64)
        entry, score, missing = np.zeros(len(rows), np.int64), np.zeros(len(rows)), np.ones(len(rows), bool)
        entry[at], score[at], missing[at] = found["entry"], found["score"], False
        return pa.StructArray.from_arrays(
            [pa.array(entry, pa.int64()), pa.array(score)], ["entry", "score"], mask=pa.array(missing)
        )

    return best


def _ranked(found: DataFrame, n: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "entry")
    return (
        found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)
    )


def _to_batch(found: pd.DataFrame, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pandas(found[names], preserve_index=False)


def _sent(travelling: pa.Table | Broadcast) -> pa.Table:
    return travelling.value if isinstance(travelling, Broadcast) else travelling


def _scan_entries(travelling: pa.Table | Broadcast, n: int, earlier: bool):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = _Rows.of(_sent(travelling), "query")
        kept, new, least = [], 0, None
        for batch in batches:
            found = _match(queries, _Rows.of(batch, "entry"), n, earlier, least)
            if not len(found):
                continue
            kept.append(found)
            new += len(found)
            # Merged when half as many as there are have come: the longer the scan, the more seldom.
            if 2 * new > len(kept[0]):
                kept, new = [_best(pd.concat(kept), n)], 0
                least = _least(queries, kept[0], n)
        if kept:
            yield _to_batch(_best(pd.concat(kept), n), ["query", "entry", "score"])

    return scan


def _least(queries: _Rows, best: pd.DataFrame, n: int) -> np.ndarray:
    """Per query row, just below the ``n``-th best score of its query in units: an equal one may have the smaller id."""
    nth = best[best.groupby("query", sort=False).cumcount() == n - 1]
    ids, of_row = np.unique(queries.ids, return_inverse=True)
    least = np.full(len(ids), -np.inf)
    units = np.rint(nth["score"].to_numpy(dtype=np.float64) * _UNITS)
    least[np.searchsorted(ids, nth["query"].to_numpy())] = units - 0.5 - np.abs(units) * 1e-15
    return least[of_row]


def _scan_queries(travelling: pa.Table | Broadcast, n: int, earlier: bool):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = _Rows.of(_sent(travelling), "entry")
        for batch in batches:
            found = _match(_Rows.of(batch, "query"), entries, n, earlier)
            if len(found):
                rank = found.groupby("query", sort=False).cumcount() + 1
                yield _to_batch(
                    found.assign(rank=rank.astype("int32")), ["query", "entry", "score", "rank"]
                )

    return scan


def _blocks(side: DataFrame, name: str, block_rows: int, most: int, longest: int) -> DataFrame:
    """Blocks per bucket: one per ``block_rows`` rows, but not above ``most`` unless a block had more than ``longest`` rows."""
    enough = F.least(F.ceil(F.count("*") / F.lit(block_rows)), F.lit(most))
    needed = F.ceil(F.count("*") / F.lit(longest))
    return side.groupBy("bucket").agg(F.greatest(enough, needed).cast("int").alias(name))


def _block_pairs(
    entries: DataFrame,
    queries: DataFrame,
    n: int,
    earlier: bool,
    schema: T.StructType,
    block_rows: int,
    most: int,
    longest: int,
) -> DataFrame:
    bounds = (block_rows, most, longest)
    # One row per bucket; only buckets with rows on both sides can match. Marked for broadcast:
    # Spark takes a vector for one number and would send a side through the driver instead.
    cuts = _blocks(entries, "entry_blocks", *bounds).join(_blocks(queries, "query_blocks", *bounds), "bucket")
    cuts = small_side(cuts, "match-cuts")

    def cut(side: DataFrame, own: str, other: str) -> DataFrame:
        own_block = F.pmod(F.xxhash64(own), F.col(f"{own}_blocks")).cast("int")
        return (
            side.join(cuts, "bucket")
            .withColumn(f"{own}_block", own_block)
            .withColumn(f"{other}_block", F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1)))
            .select("bucket", "entry_block", "query_block", own, "vector")
        )

    key = ["bucket", "entry_block", "query_block"]

    arrow_schema = to_arrow_schema(schema)

    def match(left: pa.Table, right: pa.Table) -> pa.Table:
        found = _match(_Rows.of(right, "query"), _Rows.of(left, "entry"), n, earlier)
        if not len(found):
            return arrow_schema.empty_table()
        return pa.Table.from_pandas(
            found[["query", "entry", "score"]], schema=arrow_schema, preserve_index=False
        )

    return (
        cut(entries, "entry", "query")
        .groupBy(*key)
        .cogroup(cut(queries, "query", "entry").groupBy(*key))
        .applyInArrow(match, schema)
    )


def _crowded(side: DataFrame, count: int, rows: int) -> bool:
    """A bucket of the side has more than ``rows`` rows."""
    return count > rows and side.groupBy("bucket").count().agg(F.max("count").alias("n")).first()["n"] > rows


def _in_pieces(
    entries: DataFrame, queries: DataFrame, n: int, earlier: bool, schema: T.StructType, pieces: int, entries_travel: bool
) -> DataFrame:
    """``query, entry, score``: the best of each query and, if entries travel, of each piece of them.

    Both sides are written first, as each is read again and again, the travelling one by
    piece, and deleted at the end.
    """
    spark = entries.sparkSession
    travels, stays = (entries, queries) if entries_travel else (queries, entries)
    sides = fresh_path(spark, "match-sides")
    dealt = travels.repartition(pieces).withColumn("piece", F.spark_partition_id())
    dealt.write.partitionBy("piece").parquet(f"{sides}/dealt")
    stays.write.parquet(f"{sides}/scanned")
    dealt = spark.read.schema(dealt.schema).parquet(f"{sides}/dealt")
    # A task gives n rows per travelling query, so there are no more tasks than keep every core busy.
    most_tasks = GROUPS_PER_CORE * spark.sparkContext.defaultParallelism
    scanned = spark.read.schema(stays.schema).parquet(f"{sides}/scanned").coalesce(most_tasks)
    path = fresh_path(spark, "match-best")
    ranked = T.StructType(schema.fields + [T.StructField("rank", T.IntegerType())])

    def match(piece: int) -> None:
        sent = spark.sparkContext.broadcast(dealt.filter(F.col("piece") == piece).drop("piece").toArrow())
        if entries_travel:
            found = scanned.mapInArrow(_scan_queries(sent, n, earlier), ranked)
        else:
            found = _ranked(scanned.mapInArrow(_scan_entries(sent, n, earlier), schema), n)
        found.drop("rank").write.parquet(f"{path}/piece={piece}")
        sent.destroy()  # with its copies on the executors' disks

    for row in dealt.select("piece").distinct().collect():
        match(row["piece"])
    discard(spark, sides)
    return spark.read.schema(schema).parquet(path).select(*schema.names)
