"""Product codes of vectors, exact in whole numbers, over Hilbert-sorted blocks.

Vectors become whole numbers and are cut into parts; each part position has a
codebook, fitted by rounds of nearest-entry assignment and floored means.

Parts are sorted along a Hilbert curve, position by position, and packed into
flat blocks of neighbours. A block stores the least and largest value of every
component and their sums. In a round, the distances between a block's box and
the entries leave a shortlist: an entry whose least distance to the box is
larger than another's largest can't be nearest to any point of it. Where one
entry remains, the block counts as a whole, by its sums; otherwise its points
are compared with the shortlist alone, in exact whole numbers.

A round sends one row per task, part, entry and component. Blocks are sorted
once: the range partitioning by curve position ends with the row number, so
equal vectors, however many, are dealt out like others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuscle.llm.skew import attach
from corpuscle.llm.topk import usable
from corpuscle.sources.shared import materialise

SCALE = 4096.0
PARTS = 8
ENTRIES = 16
ROUNDS = 6
# Points of a block.
BLOCK = 128
_WHOLE = pa.decimal128(38, 0)


def whole(vector: Column, scale: float = SCALE) -> Column:
    """Components ``floor(scale * x)``, kept as doubles, which hold them exactly."""
    return F.transform(vector, lambda x: _floored(x * F.lit(scale)))


def _floored(x: Column) -> Column:
    # Spark's floor gives a long; beyond 2**52 every double is whole already.
    return F.when(F.abs(x) < F.lit(float(1 << 52)), F.floor(x).cast("double")).otherwise(x)


def _cuts(dim: int, parts: int) -> int:
    """Components of a part; vectors are filled with zeros up to ``parts`` times this."""
    return max(1, -(-dim // parts))


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows, short ones filled with zeros."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = vectors.flatten().to_numpy(zero_copy_only=False)
    return out


def _small(width: int) -> int:
    """Below this, squared distances of ``width`` components fit 64 bits."""
    return isqrt((1 << 62) // width) // 2


def _exact(values: np.ndarray) -> np.ndarray:
    """Rows of whole doubles as int64, or as Python numbers where squared distances could leave 64 bits."""
    if np.abs(values).max(initial=0) < _small(values.shape[1]):
        return values.astype(np.int64)
    return np.array([[int(x) for x in row] for row in values], dtype=object).reshape(values.shape)


def hilbert(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Position of each row along a Hilbert curve through the box from ``low`` to ``high``.

    Coordinates are rounded to as many bits as leave 62 for the position, and
    beyond 62 components only the first 62 count: it is an order, no more. The
    transposed form of the curve: undo the turns from the highest bit down, then
    Gray-code the bits.
    """
    points, low, high = points[:, :62], low[:62], high[:62]
    n, dim = points.shape
    bits = max(1, min(16, 62 // dim))
    span = np.where(high > low, high - low, 1.0)
    x = np.minimum((points - low) / span * (1 << bits), (1 << bits) - 1).astype(np.int64).T.copy()
    bit = 1 << (bits - 1)
    while bit > 1:
        mask = bit - 1
        for i in range(dim):
            turned = (x[i] & bit) != 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & mask)
            x[0] ^= np.where(turned, mask, swap)
            x[i] ^= swap
        bit >>= 1
    for i in range(1, dim):
        x[i] ^= x[i - 1]
    flip = np.zeros(n, dtype=np.int64)
    bit = 1 << (bits - 1)
    while bit > 1:
        flip ^= np.where((x[dim - 1] & bit) != 0, bit - 1, 0)
        bit >>= 1
    x ^= flip
    place = np.zeros(n, dtype=np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(dim):
            place = (place << 1) | ((x[i] >> b) & 1)
    return place


def _curve(rows: DataFrame, parts: int, width: int, low: np.ndarray, high: np.ndarray) -> DataFrame:
    """``part, place, row, point`` for every part of every vector."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _matrix(batch.column(1), parts * width)
            for part in range(parts):
                a, b = part * width, (part + 1) * width
                points = np.ascontiguousarray(values[:, a:b])
                offsets = pa.array(np.arange(len(points) + 1, dtype=np.int32) * width)
                yield pa.record_batch(
                    [
                        pa.array(np.full(len(points), part, dtype=np.int32)),
                        pa.array(hilbert(points, low[a:b], high[a:b])),
                        batch.column(0),
                        pa.ListArray.from_arrays(offsets, pa.array(points.ravel())),
                    ],
                    names=["part", "place", "row", "point"],
                )

    return rows.select("row", "vector").mapInArrow(cut, "part int, place bigint, row bigint, point array<double>")


def _pack(curve: DataFrame, width: int, block: int) -> DataFrame:
    """Flat blocks of neighbours on the curve, with boxes and sums."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None

        def packed(table: pa.Table, part: int) -> pa.RecordBatch:
            points = table.column("point").combine_chunks().flatten().to_numpy().reshape(-1, width)
            exact = _exact(points)
            sums = [int(x) for x in exact.sum(axis=0)] if len(points) else []
            return pa.record_batch(
                [
                    pa.array([part], pa.int32()),
                    pa.array([table.column("row").to_pylist()], pa.list_(pa.int64())),
                    pa.array([points.ravel()], pa.list_(pa.float64())),
                    pa.array([points.min(axis=0)], pa.list_(pa.float64())),
                    pa.array([points.max(axis=0)], pa.list_(pa.float64())),
                    pa.array([[Decimal(x) for x in sums]], pa.list_(_WHOLE)),
                ],
                names=["part", "rows", "points", "low", "high", "sums"],
            )

        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            rest = None
            part = table.column("part").to_numpy()
            ends = [*(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(part)]
            at = 0
            for end in ends:
                while end - at >= block or (end < len(part) and end > at):
                    to = min(at + block, end)
                    yield packed(table.slice(at, to - at), int(part[at]))
                    at = to
            if at < len(part):
                rest = table.slice(at)
        if rest is not None and rest.num_rows:
            yield packed(rest, int(rest.column("part")[0].as_py()))

    ordered = curve.repartitionByRange("part", "place", "row").sortWithinPartitions("part", "place", "row")
    return ordered.mapInArrow(
        blocks,
        "part int, rows array<bigint>, points array<double>, low array<double>, high array<double>, sums array<decimal(38,0)>",
    )


def shortlist(low: np.ndarray, high: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Numbers of the entries that may be nearest to a point of the box, in order; whole numbers all through."""
    below, above = low - book, book - high
    least = np.maximum(np.maximum(below, above), 0)
    most = np.maximum(abs(below), abs(above))
    reach = (most * most).sum(axis=1).min()
    return np.flatnonzero(((least * least).sum(axis=1) <= reach).astype(bool))


def _distances(points: np.ndarray, book: np.ndarray) -> np.ndarray:
    away = points[:, None, :] - book[None, :, :]
    return (away * away).sum(axis=2)


class _Blocks:
    """Reads block rows; numbers are int64 where that is exact, else Python's."""

    def __init__(self, books: list[np.ndarray], width: int):
        self.width = width
        self.books = books

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """(part, rows, points, sums, shortlist, entries of the shortlist)"""
        for batch in batches:
            low, high = (_exact(batch.column(c).flatten().to_numpy().reshape(-1, self.width)) for c in ("low", "high"))
            for i, part in enumerate(batch.column("part").to_pylist()):
                points = _exact(batch.column("points")[i].values.to_numpy().reshape(-1, self.width))
                kind = np.result_type(points, low, high, self.books[part])
                points, book = points.astype(kind), self.books[part].astype(kind)
                near = shortlist(low[i].astype(kind), high[i].astype(kind), book)
                yield part, batch.column("rows")[i], points, batch.column("sums")[i], near, book[near]


def _round(blocks: DataFrame, books: list[np.ndarray], width: int) -> DataFrame:
    """Per part, entry and component: how many points it is nearest to, and their sum."""
    read = _Blocks(books, width)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[int, int], int] = {}
        sums: dict[tuple[int, int], np.ndarray] = {}

        def add(key: tuple[int, int], n: int, total: np.ndarray) -> None:
            counts[key] = counts.get(key, 0) + n
            sums[key] = sums[key] + total if key in sums else total

        for part, rows, points, total, near, book in read(batches):
            if len(near) == 1:
                add((part, int(near[0])), len(rows), np.array([int(x) for x in total.as_py()], dtype=object))
                continue
            nearest = _distances(points, book).argmin(axis=1)
            for i in np.unique(nearest):
                mine = points[nearest == i]
                add((part, int(near[i])), len(mine), mine.sum(axis=0).astype(object))
        found = [(*key, at, counts[key], Decimal(int(x))) for key, total in sums.items() for at, x in enumerate(total)]
        columns = list(zip(*found, strict=True)) if found else [[]] * 5
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), _WHOLE]
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["part", "entry", "at", "n", "total"])

    found = blocks.mapInArrow(tally, "part int, entry int, at int, n bigint, total decimal(38,0)")
    return found.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("total").cast("decimal(38,0)").alias("total"))


def _assigned(blocks: DataFrame, books: list[np.ndarray], width: int) -> DataFrame:
    """``row, part, code, error`` of every part."""
    read = _Blocks(books, width)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows, points, _, near, book in read(batches):
            distances = _distances(points, book)
            codes = distances.argmin(axis=1)
            error = distances[np.arange(len(codes)), codes]
            n = len(codes)
            yield pa.record_batch(
                [
                    rows.values,
                    pa.array(np.full(n, part, dtype=np.int32)),
                    pa.array(near[codes].astype(np.int32)),
                    pa.array([int(x) for x in error], pa.int64()),
                ],
                names=["row", "part", "code", "error"],
            )

    return blocks.mapInArrow(nearest, "row bigint, part int, code int, error bigint")


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components by part, entry and position, as decimal numbers joined by commas."""
    return hashlib.sha256(",".join(str(int(x)) for book in books for x in book.ravel()).encode()).hexdigest()


def _prepared(vectors: DataFrame, key: str, vector: str, label: str, scale: float) -> DataFrame:
    rows = vectors.select(
        F.col(key).alias("vec_id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("vector")
    ).filter(usable("vector"))
    rows = rows.withColumn("vector", whole(F.col("vector"), scale)).withColumn("row", F.monotonically_increasing_id())
    return materialise(rows.select("row", "vec_id", "label", "vector"), "whole-vectors")


def fit_and_encode(
    vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", label: str = "label", scale: float = SCALE,
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, block: int = BLOCK,
) -> tuple[DataFrame, list[np.ndarray]]:
    """``vec_id, label, code, error`` of every usable vector, and the codebooks (one matrix per part).

    A codebook starts as the parts of the vectors with the ``entries`` smallest
    keys (fewer if there are fewer vectors; of equal keys the smaller vector
    first, null keys last). Each round every part goes to its nearest entry,
    ties to the lower one, and an entry becomes the floored mean of its parts;
    entries without parts stay. ``code`` has two hexadecimal digits per part.

    Vectors that are null or hold null or non-finite components are dropped; a
    vector shorter than the longest, or a length that ``parts`` doesn't divide,
    is filled with zeros. Repeated rows and keys are coded row by row. Numbers
    are exact whatever their size; an error beyond 64 bits, and a component
    that ``scale`` takes beyond a double, raises. An empty
    table gives no rows and empty codebooks. Other columns are ignored.
    """
    if not 0 < entries <= 256:
        raise ValueError("two hexadecimal digits name 256 entries at most")
    rows = _prepared(vectors, key, vector, label, scale)
    dim = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    width = _cuts(dim, parts)
    # At most ``entries`` rows.
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).select("vector").toArrow()
    seeds = _matrix(first.column(0).combine_chunks(), parts * width) if first.num_rows else np.zeros((0, parts * width))
    books = [_exact(seeds[:, p * width : (p + 1) * width]) for p in range(parts)]
    if not first.num_rows:
        return rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("bigint").alias("error")), books
    # One row per component, filled up with the zeros that short vectors get.
    ends = rows.select(F.posexplode("vector").alias("at", "x")).groupBy("at").agg(F.min("x"), F.max("x")).collect()
    low, high = np.zeros(parts * width), np.zeros(parts * width)
    for at, least, most in ends:
        low[at], high[at] = min(least, 0.0), max(most, 0.0)
    blocks = materialise(_pack(_curve(rows, parts, width, low, high), width, block), "code-blocks")
    for _ in range(rounds):
        # One row per component of a codebook.
        for part, entry, at, n, total in _round(blocks, books, width).collect():
            book = books[part]
            mean = int(total) // n
            if book.dtype != object and abs(mean) >= _small(width):
                books[part] = book = book.astype(object)
            book[entry, at] = mean
    hexes = F.transform(F.array_sort(F.collect_list(F.struct("part", "code"))), lambda x: F.lpad(F.lower(F.hex(x["code"])), 2, "0"))
    coded = _assigned(blocks, books, width).groupBy("row").agg(F.array_join(hexes, "").alias("code"), F.sum("error").alias("error"))
    return coded.join(rows.select("row", "vec_id", "label"), "row").select("vec_id", "label", "code", "error"), books


def encode(vectors: DataFrame, **options) -> DataFrame:
    """``fit_and_encode``'s rows with ``label_error``, the sum of errors per label, and ``codebooks_sha256``."""
    coded, books = fit_and_encode(vectors, **options)
    coded = materialise(coded, "codes")
    totals = coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("size"))
    totals = materialise(totals, "label-errors")
    return attach(coded, totals, ["label"], "size").select(
        "vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")
    )
