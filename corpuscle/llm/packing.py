"""Best-fit packing by linear grouping.

Documents become runs of token ids, runs become pieces of at most ``capacity``
ids, and pieces are packed into as few sequences as possible.

Only the histogram of piece lengths reaches the driver: at most ``capacity``
rows, however many documents there are. The plan is made on the histogram:

1. lengths above ``capacity * small_share`` are cut, in descending order, into
   ``groups`` groups of equal cardinality, each rounded up to its longest;
2. configurations of the few rounded sizes are chosen: the largest size left,
   completed by the fullest multiset of the others, as often as stock allows;
3. actual lengths take the places of the rounded ones; a sequence that they
   don't fill to the last id is taken apart again;
4. these lengths and the small ones go, longest first, to the fullest sequence
   that still fits.

The plan is a list of intervals (length, first rank, number, first sequence,
offset) whose number depends on ``capacity`` and ``groups`` only. Pieces are
ranked within their length and joined with it.
"""

from __future__ import annotations

import sys
import zlib
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from math import ceil, isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuscle.llm.memory import giving_back
from corpuscle.sources.shared import materialise

CAPACITY = 2048
GROUPS = 1024
SMALL_SHARE = 1 / 8
# Rows of one length that are ranked together, at least.
RANKED_TOGETHER = 512
# Words whose ids a worker remembers, and the longest such word.
REMEMBERED = 200_000
REMEMBERED_CHARS = 40

_PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
_PIECES_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
)
_MARKS = ",.!?;:%&$#*|"


def default_vocabulary() -> str:
    """The place of the tokenizer file on this machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class _Words(dict):
    """Ids of words as little-endian bytes, encoded when first asked for."""

    def __init__(self, vocabulary: str | None):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        super().__init__({"": b""})
        self.earlier: dict[str, bytes] = {}
        self.tokenizer = Tokenizer.from_file(vocabulary or default_vocabulary())
        self.merges = self.tokenizer.model
        bytewise = ByteLevel(add_prefix_space=False, use_regex=False)
        self.bytewise = {ord(c): bytewise.pre_tokenize_str(c)[0][0] for c in map(chr, range(0x80, 0x250)) if c.isalpha()}

    def encode(self, word: str) -> bytes:
        if word.isalpha() and word == word.lower() and (word.isascii() or max(word) < "\u0250"):
            # Composed lower-case letters alone are one run that no earlier step changes.
            bytewise = word if word.isascii() else word.translate(self.bytewise)
            found = [token.id for token in self.merges.tokenize(bytewise)]
        else:
            found = self.tokenizer.encode(word, add_special_tokens=False).ids
        ids = array("I", found)
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def __missing__(self, word: str) -> bytes:
        ids = self.earlier.get(word)
        if ids is None:
            ids = self.ids(word)
        if len(word) <= REMEMBERED_CHARS:
            self[word] = ids
        return ids

    def ids(self, word: str) -> bytes:
        stem = word.rstrip(_MARKS)
        # Marks after a letter are a token run of their own, and below U+0250 letters are
        # composed and lower-cased one by one, so such words share the ids of their stem.
        if stem and stem != word.lower() and stem[-1].isalpha() and (word.isascii() or max(word) < "\u0250" and "\u0130" not in word):
            return self[stem.lower()] + self[word[len(stem) :]]
        return self.encode(word)

    def forget(self) -> None:
        """Forget the words that weren't met since this was last called, so that common ones stay."""
        self.earlier = dict(self)
        self.clear()
        self[""] = b""


class _Encoder:
    """Ids of texts as little-endian bytes.

    The tokenizer drops white space and no token reaches across it, so a text's
    ids are those of its words, one after the other.
    """

    def __init__(self, vocabulary: str | None):
        self.words = _Words(vocabulary)

    def __call__(self, text: str) -> bytes:
        words = self.words
        if len(words) > REMEMBERED // 2:
            words.forget()
        return b"".join(map(words.__getitem__, text.replace("\n", " ").split(" ")))


_KEPT: dict[str | None, _Encoder] = {}


def _kept_encoder(vocabulary: str | None) -> _Encoder:
    """The worker's encoder: what one task has learnt serves the next."""
    if vocabulary not in _KEPT:
        _KEPT[vocabulary] = _Encoder(vocabulary)
    return _KEPT[vocabulary]


def pieces(
    docs: DataFrame, *, text: str = "text", key: str = "doc_id", vocabulary: str | None = None,
    capacity: int = CAPACITY, end_id: int = 0,
) -> DataFrame:
    """Token pieces: ``doc_id, piece, start, length, ids_crc32``, one row per piece.

    A null or empty text has the end id alone. Only runs longer than
    ``capacity`` are cut; their last piece may be shorter.
    """
    tail = np.asarray([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _kept_encoder(vocabulary)
        for batch in batches:
            rows: list[tuple] = []
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(body.as_py() or "") + tail
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _PIECES_ARROW, strict=True)], schema=_PIECES_ARROW)

    narrow = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return narrow.mapInArrow(giving_back(cut), _PIECES)


class _Run:
    """Sequences with the same lengths in the same order."""

    __slots__ = ("n", "room", "held")

    def __init__(self, n: int, room: int, held: tuple[tuple[int, int], ...]):
        self.n, self.room, self.held = n, room, held

    def split(self, n: int) -> tuple[_Run, _Run]:
        """The first ``n`` sequences and the others."""
        later = tuple((length, rank + n) for length, rank in self.held)
        return _Run(n, self.room, self.held), _Run(self.n - n, self.room, later)

    def add(self, length: int, rank: int, times: int) -> _Run:
        """Each sequence gets ``times`` more pieces, ranks from ``rank`` on."""
        more = tuple((length, rank + i * self.n) for i in range(times))
        return _Run(self.n, self.room - length * times, self.held + more)


def _grouped(counts: dict[int, int], groups: int) -> list[list[list[int]]]:
    """Descending lengths in groups of equal cardinality: lists of [length, first rank, number]."""
    total = sum(counts.values())
    each = max(1, ceil(total / groups))
    out: list[list[list[int]]] = []
    room = 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            if room == 0:
                out.append([])
                room = each
            take = min(left, room)
            out[-1].append([length, rank, take])
            rank, left, room = rank + take, left - take, room - take
    return out


def _fullest(sizes: list[int], stock: list[int], room: int) -> list[int]:
    """How many of each size fill ``room`` best."""
    reach = np.zeros(room + 1, dtype=bool)
    reach[0] = True
    before = []
    for size, n in zip(sizes, stock, strict=True):
        before.append(reach)
        for _ in range(min(n, room // size)):
            more = reach.copy()
            more[size:] |= reach[:-size]
            if (more == reach).all():
                break
            reach = more
        if reach[room]:
            break
    at = int(np.flatnonzero(reach)[-1])
    chosen = [0] * len(sizes)
    for i in range(len(before) - 1, -1, -1):
        while not before[i][at]:
            at -= sizes[i]
            chosen[i] += 1
    return chosen


def _configured(groups: list[list[list[int]]], capacity: int) -> list[_Run]:
    """Sequences of large lengths: configurations of rounded sizes, then the actual lengths."""
    sizes = [group[0][0] for group in groups]
    stock = [sum(n for _, _, n in group) for group in groups]
    runs: list[_Run] = []
    first = 0
    while first < len(groups):
        if not stock[first]:
            first += 1
            continue
        stock[first] -= 1
        chosen = _fullest(sizes[first:], stock[first:], capacity - sizes[first])
        stock[first] += 1
        chosen[0] += 1
        times = min(stock[first + i] // n for i, n in enumerate(chosen) if n)
        slots = []
        for i, n in enumerate(chosen):
            stock[first + i] -= n * times
            for _ in range(n):
                slots.append(_take(groups[first + i], times))
        runs += _aligned(slots, times, capacity)
    return runs


def _take(group: list[list[int]], n: int) -> list[tuple[int, int, int]]:
    """The next ``n`` pieces of a group: (length, first rank, number)."""
    out = []
    while n:
        length, rank, have = group[0]
        m = min(n, have)
        out.append((length, rank, m))
        if m == have:
            group.pop(0)
        else:
            group[0] = [length, rank + m, have - m]
        n -= m
    return out


def _aligned(slots: list[list[tuple[int, int, int]]], times: int, capacity: int) -> list[_Run]:
    """Cut ``times`` sequences where any slot changes its length."""
    cuts = {0, times}
    for slot in slots:
        at = 0
        for _, _, n in slot:
            at += n
            cuts.add(at)
    edges = sorted(cuts)
    columns = []
    for slot in slots:
        column, at, i = [], 0, 0
        for edge in edges[:-1]:
            while edge >= at + slot[i][2]:
                at += slot[i][2]
                i += 1
            column.append((slot[i][0], slot[i][1] + edge - at))
        columns.append(column)
    runs = []
    for j, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
        held = tuple(column[j] for column in columns)
        runs.append(_Run(b - a, capacity - sum(length for length, _ in held), held))
    return runs


def plan(counts: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS, small_share: float = SMALL_SHARE) -> list[_Run]:
    """Runs of sequences that hold every piece of the histogram exactly once."""
    if any(not 0 < length <= capacity for length in counts):
        raise ValueError("lengths lie between 1 and the capacity")
    limit = int(capacity * small_share)
    large = {k: n for k, n in counts.items() if k > limit}
    by_room: list[list[_Run]] = [[] for _ in range(capacity + 1)]
    loose = [(length, 0, n) for length, n in counts.items() if length <= limit]
    for run in _configured(_grouped(large, groups), capacity):
        if run.room:
            loose += [(length, rank, run.n) for length, rank in run.held]
        else:
            by_room[run.room].append(run)
    for length, rank, left in sorted(loose, key=lambda piece: (-piece[0], piece[1])):
        for room in range(length, capacity + 1):
            fit = room // length
            # What a run gains leaves it less than ``length``, so it isn't met again.
            while left and by_room[room]:
                run = by_room[room].pop()
                whole = min(run.n, left // fit)
                if whole < run.n:
                    run, rest = run.split(whole) if whole else (None, run)
                    if part := left - whole * fit:
                        one, rest = rest.split(1)
                        one = one.add(length, rank + whole * fit, part)
                        by_room[one.room].append(one)
                    if rest.n:
                        by_room[room].append(rest)
                    used = left
                else:
                    used = whole * fit
                if run is not None:
                    run = run.add(length, rank, fit)
                    by_room[run.room].append(run)
                rank, left = rank + used, left - used
            if not left:
                break
        if left:
            fit = capacity // length
            if whole := left // fit:
                run = _Run(whole, capacity, ()).add(length, rank, fit)
                by_room[run.room].append(run)
            if part := left - whole * fit:
                run = _Run(1, capacity, ()).add(length, rank + whole * fit, part)
                by_room[run.room].append(run)
    return [run for runs in by_room for run in runs]


def intervals(runs: Iterable[_Run]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, number, first sequence, offset) for every place of every run."""
    out = []
    sequence = 0
    for run in runs:
        offset = 0
        for length, rank in run.held:
            out.append((length, rank, run.n, sequence, offset))
            offset += length
        sequence += run.n
    return out


def pack_pieces(
    cut: DataFrame, *, capacity: int = CAPACITY, groups: int = GROUPS, small_share: float = SMALL_SHARE
) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a stored table of pieces.

    ``cut`` is read twice, so pass a table that is written. Equal rows are
    separate pieces; which of them gets which place is not defined.
    """
    spark = cut.sparkSession
    # At most ``capacity`` rows.
    counts = {int(r["length"]): int(r["n"]) for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = intervals(plan(counts, capacity, groups, small_share))
    plan_table = spark.createDataFrame(places, "length bigint, first_rank bigint, n bigint, first_sequence bigint, offset bigint")
    # Rows of one length are dealt out, so that a common length isn't ranked in one task.
    shares = spark.createDataFrame(
        [(length, ceil(n / max(RANKED_TOGETHER, isqrt(n)))) for length, n in counts.items()], "length bigint, shares int"
    )
    dealt = cut.join(F.broadcast(shares), "length").withColumn(
        "share", F.expr("pmod(xxhash64(doc_id, piece, ids_crc32, rand(7)), shares)").cast("int")
    )
    return _placed(dealt, plan_table)


def _placed(dealt: DataFrame, plan_table: DataFrame) -> DataFrame:
    dealt = materialise(dealt, "packing-dealt")
    before = Window.partitionBy("length").orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy("length", "share")
        .agg(F.count("*").alias("rows"))
        .select("length", "share", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("earlier"))
    )
    inside = Window.partitionBy("length", "share").orderBy("doc_id", "piece", "start")
    ranked = dealt.withColumn("inside", F.row_number().over(inside) - 1).join(offsets, ["length", "share"])
    ranked = ranked.withColumn("rank", F.col("inside") + F.col("earlier"))
    p = F.broadcast(plan_table.withColumnRenamed("length", "p_length"))
    placed = ranked.join(
        p,
        (F.col("length") == F.col("p_length"))
        & (F.col("rank") >= F.col("first_rank"))
        & (F.col("rank") < F.col("first_rank") + F.col("n")),
    )
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("first_sequence") + F.col("rank") - F.col("first_rank")).alias("sequence_id"),
        F.col("offset"),
    )


def pack(docs: DataFrame, **options) -> DataFrame:
    """Tokenise, cut and pack whole documents.

    One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id,
    offset``. A null or empty text is one piece that holds the end id; a
    repeated row is packed as often as it is there; an empty table gives no
    rows; columns other than key and text are ignored.
    """
    packing = {k: options.pop(k) for k in ("groups", "small_share") if k in options}
    capacity = options.get("capacity", CAPACITY)
    cut = materialise(pieces(docs, **options), "packing-pieces")
    return pack_pieces(cut, capacity=capacity, **packing)


def lower_bound(counts: dict[int, int], capacity: int = CAPACITY) -> int:
    """Sequences that any packing of the histogram needs at least."""
    full = Counter({k: n for k, n in counts.items() if n})
    return ceil(sum(k * n for k, n in full.items()) / capacity)
