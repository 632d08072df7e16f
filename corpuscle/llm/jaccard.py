"""Exact Jaccard join of whole texts on word shingles.

The index is a count-vector R-tree. The shingles of a text are hashed into
groups; the numbers per group are its point, and two texts share at most the sum
of the coordinates' minima. A page of points has the coordinates' maxima, so the
same sum bounds what a text can share with any text of the page.

Points of unrelated texts of one size lie close to each other in every single
coordinate, so a tree over all points would visit nearly all pages. The root is
therefore a directory by shingle: of ``n`` shingles in one fixed order the first
``n - ceil(t n) + 1`` lead to a branch, and texts that are similar enough meet
in a branch for certain. The order puts frequent shingles last.

1. Equal sets become one; links are only sought between different sets.
2. Every set is compared with the smallest set of each branch. That leaves one
   component in the branch of a group of near copies, however large.
3. Sets of large branches with several components are led to new branches by the
   shingles that are rarest among them. There the sets outside the largest
   component meet those of its members that have least of their own; those still
   outside descend: first to pages, then to points of other components, bounded
   by the minima and by what is their own.
4. What survives is verified on whole shingle sets, block against block; visits to
   pages are compared where they meet, and no list of their pairs is made.

No branch is gathered in one task: pivots are minima, and all else are joins
that Spark can split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuscle.llm import hashing
from corpuscle.llm.components import components
from corpuscle.llm.memory import giving_back
from corpuscle.sources.shared import materialise, small_side

WORDS = 5
PERCENT = 80
GROUPS = 64
# The frequent shingles that come last in the order; any set of them gives the same links.
FREQUENT = 400_000
FREQUENT_FROM = 8
COUNTER_BITS = 23
# Places of the order that a set keeps to tell which of its first shingles another set would have met.
MARKS = 8
PAGE = 32
# Members of the largest component of a branch that the others meet before all of them.
MATES = 8
# Sets of large branches that a rare shingle has at most.
RARE = 8
# Sets of a family that are compared with each other in one task.
BLOCK = 256
# Rows of ids that a join may copy to every executor.
COPIED_ROWS = 1_000_000


def shingle_sets(part: hashing.Slice, k: int = WORDS) -> Iterator[np.ndarray]:
    """The distinct shingle hashes of each text of a slice, ascending.

    A text of fewer than ``k`` words has its whole word sequence as one shingle,
    a text without words has none.
    """
    words = hashing.Hashed(part).words(hashing.NOT_BLANK)
    at, gram = hashing.grams(words, k)
    n = len(part.bounds) - 1
    gram_ends = np.searchsorted(words.text[at], np.arange(n + 1))
    word_ends = np.searchsorted(words.text, np.arange(n + 1))
    for i in range(n):
        found = gram[gram_ends[i] : gram_ends[i + 1]]
        if len(found) > 1:
            found = np.sort(found)
            found = found[np.concatenate(([True], found[1:] != found[:-1]))]
        elif not len(found) and word_ends[i + 1] > word_ends[i]:
            own = words.hash[word_ends[i] : word_ends[i + 1]]
            short = hashing.Words(np.zeros(len(own), np.int64), own, own, own)
            found = hashing.mix(hashing.grams(short, len(own))[1] + np.uint64(len(own)))
        yield found


def set_id(found: np.ndarray) -> bytes:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


def frequent_shingles(docs: DataFrame, k: int = WORDS, at_most: int = FREQUENT, at_least: int = FREQUENT_FROM) -> np.ndarray:
    """Shingles that many texts have, the rarest of them first; at most ``at_most``.

    A task counts its shingles in a table of counters and keeps those whose
    counter reaches two; only small hashes, as others come late in the order
    anyway. It is an order, not a filter: a miscount costs time, no link.
    """
    limit = np.uint64((1 << 64) * 2 // 5)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        counters = np.zeros(1 << COUNTER_BITS, dtype=np.uint16)
        for batch in batches:
            for part in hashing.slices(batch.column(0)):
                words = hashing.Hashed(part).words(hashing.NOT_BLANK)
                gram = hashing.grams(words, k)[1]
                found, n = np.unique(gram[gram < limit], return_counts=True)
                place = (found & np.uint64(len(counters) - 1)).astype(np.int64)
                total = np.minimum(counters[place].astype(np.int64) + n, 60_000)
                counters[place] = total
                often = total > 1
                seen.update(zip(found[often].tolist(), total[often].tolist(), strict=True))
            if len(seen) > 8 * at_most:
                seen = dict(sorted(seen.items(), key=lambda x: -x[1])[: 4 * at_most])
        keys = np.fromiter(seen.keys(), dtype=np.uint64, count=len(seen)).view(np.int64)
        yield pa.record_batch([pa.array(keys), pa.array(list(seen.values()), pa.int64())], names=["shingle", "n"])

    counted = docs.select("text").mapInArrow(giving_back(count), "shingle bigint, n bigint").groupBy("shingle").agg(F.sum("n").alias("n"))
    # At most ``at_most`` numbers.
    found = counted.filter(F.col("n") >= at_least).orderBy(F.desc("n"), "shingle").limit(at_most).select("shingle").toArrow()
    return found.column(0).to_numpy()[::-1].astype(np.int64).view(np.uint64)


_POINTS = "row_id bigint, doc_id bigint, n bigint, set_id binary, branches array<bigint>, marks array<bigint>, counts array<int>"
_POINTS_ARROW = pa.schema(
    [
        ("row_id", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("set_id", pa.binary()),
        ("branches", pa.list_(pa.int64())), ("marks", pa.list_(pa.int64())), ("counts", pa.list_(pa.int32())),
    ]
)


def points(docs: DataFrame, frequent: np.ndarray, k: int, percent: int) -> DataFrame:
    """Per row: size and id of the shingle set, its branches, and its point."""
    place = np.argsort(frequent, kind="stable")
    known = frequent[place]

    def ordered(found: np.ndarray, first: int) -> np.ndarray:
        """Places in the order of a set's first shingles: rare ones by hash, then frequent ones by rank."""
        rare = (found >> np.uint64(2)).view(np.int64)
        if not len(known):
            return rare[:first]
        at = np.minimum(np.searchsorted(known, found), len(known) - 1)
        late = known[at] == found
        if not late.any():
            return rare[:first]
        return np.concatenate((rare[~late], (1 << 62) + np.sort(place[at[late]])))[:first]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in hashing.slices(batch.column(2)):
                n, ids, branches, marks, counts, ends = [], [], [], [], [], [0]
                for found in shingle_sets(part, k):
                    size = len(found)
                    n.append(size)
                    ids.append(set_id(found) if size else None)
                    first = ordered(found, size - (percent * size + 99) // 100 + 1) if size else found
                    branches.append(first)
                    marks.append(first[(len(first) * np.arange(1, MARKS + 1) + MARKS - 1) // MARKS - 1].tolist() if size else [])
                    ends.append(ends[-1] + len(first))
                    counts.append(np.bincount((found & np.uint64(GROUPS - 1)).astype(np.int64), minlength=GROUPS))
                rows = len(n)
                yield pa.record_batch(
                    [
                        batch.column(0).slice(part.first, rows),
                        batch.column(1).slice(part.first, rows),
                        pa.array(n, pa.int64()),
                        pa.array(ids, pa.binary()),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(branches).astype(np.int64))),
                        pa.array(marks, pa.list_(pa.int64())),
                        pa.ListArray.from_arrays(
                            pa.array(np.arange(rows + 1, dtype=np.int32) * GROUPS), pa.array(np.concatenate(counts).astype(np.int32))
                        ),
                    ],
                    schema=_POINTS_ARROW,
                )

    return docs.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", "text").mapInArrow(giving_back(scan), _POINTS)


def _fits(a: str, b: str, percent: int) -> Column:
    """Sizes that two similar sets may have."""
    return F.expr(f"100 * least({a}, {b}) >= {percent} * greatest({a}, {b})")


def _shared_at_most(a: str, b: str) -> str:
    return f"aggregate(zip_with({a}, {b}, (x, y) -> least(x, y)), 0, (s, x) -> s + x)"


def _bounded(a: str, b: str, n_a: str, n_b: str, percent: int) -> Column:
    """The summed minima allow the overlap that sets of these sizes need."""
    return F.expr(f"(100 + {percent}) * {_shared_at_most(a, b)} >= {percent} * ({n_a} + {n_b})")


def _shingles(docs: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """``rep, shingles`` of the sets asked of each document: ``doc_id, asked (set_id, rep)``."""
    schema = pa.schema([("rep", pa.int64()), ("shingles", pa.list_(pa.int64()))])

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in hashing.slices(batch.column(0)):
                wanted = batch.column(1).slice(part.first, len(part.bounds) - 1).to_pylist()
                reps, lists = [], []
                for found, sets in zip(shingle_sets(part, k), wanted, strict=True):
                    here = set_id(found)
                    for one in sets:
                        if one["set_id"] == here:
                            reps.append(one["rep"])
                            lists.append(found)
                ends = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
                values = np.concatenate(lists).view(np.int64) if lists else np.zeros(0, np.int64)
                yield pa.record_batch([pa.array(reps, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(values))], schema=schema)

    texts = docs.join(small_side(asked, "jaccard-asked-shingles", COPIED_ROWS), "doc_id").select("text", "asked")
    return texts.mapInArrow(giving_back(expand), "rep bigint, shingles array<bigint>")


_TILE = ["family", "lo", "hi"]


def _sets_of_tiles(wanted: DataFrame, stands: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """``family, lo, hi, rep, shingles`` for the distinct rows ``family, lo, hi, rep``, from a document of each set."""
    asked = (
        wanted.join(stands.select("rep", "doc_id", "set_id"), "rep")
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("set_id", "rep", *_TILE)).alias("asked"))
    )
    columns = "family bigint, lo int, hi int, rep bigint, shingles array<bigint>"
    schema = pa.schema([("family", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32()), ("rep", pa.int64()), ("shingles", pa.list_(pa.int64()))])

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in hashing.slices(batch.column(0)):
                wanted = batch.column(1).slice(part.first, len(part.bounds) - 1).to_pylist()
                rows, lists = [], []
                for found, tiles in zip(shingle_sets(part, k), wanted, strict=True):
                    here = set_id(found)
                    for tile in tiles:
                        if tile["set_id"] == here:
                            rows.append((tile["family"], tile["lo"], tile["hi"], tile["rep"]))
                            lists.append(found)
                ends = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
                values = np.concatenate(lists).view(np.int64) if lists else np.zeros(0, np.int64)
                keys = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=False)] or [pa.array([], f.type) for f in list(schema)[:4]]
                yield pa.record_batch([*keys, pa.ListArray.from_arrays(pa.array(ends), pa.array(values))], schema=schema)

    texts = docs.join(small_side(asked, "jaccard-asked", COPIED_ROWS), "doc_id").select("text", "asked")
    return texts.mapInArrow(giving_back(expand), columns)


def _verified(pairs: DataFrame, stands: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Links among the stored ``pairs`` (``a``, ``b``) after comparing the whole sets.

    The sets that pairs tie together form families. A family is cut into blocks
    of about ``BLOCK`` sets and a pair goes to the tile of its two blocks, so a
    set moves once per block of its family and not once per pair. Small families
    share a tile. Shingles are made anew from a document that has the set.
    """
    family = materialise(components(pairs), "jaccard-families")
    sizes = family.groupBy("component").agg(F.count("*").alias("sets"))
    shared_tiles = max(1, ceil(family.count() / BLOCK))
    placed = materialise(
        family.join(small_side(sizes, "jaccard-family-sizes", COPIED_ROWS), "component").select(
            "node",
            F.expr(f"if(sets > {BLOCK}, component, -1 - pmod(xxhash64(component), {shared_tiles}))").alias("family"),
            F.expr(f"if(sets > {BLOCK}, cast(pmod(xxhash64(node), ceil(sets / {BLOCK})) as int), 0)").alias("block"),
        ),
        "jaccard-blocks",
    )
    at = lambda c: placed.select(F.col("node").alias(c), F.col("block").alias(f"{c}_block"))
    tiled = (
        pairs.join(placed.select(F.col("node").alias("a"), "family", F.col("block").alias("a_block")), "a")
        .join(at("b"), "b")
        .select("family", F.least("a_block", "b_block").alias("lo"), F.greatest("a_block", "b_block").alias("hi"), "a", "b")
    )
    tiled = materialise(tiled, "jaccard-tiles")
    def compare(sets: pa.Table, here: pa.Table) -> pa.Table:
        lists = sets.column("shingles").combine_chunks()
        ends = lists.offsets.to_numpy()
        values = lists.values.to_numpy(zero_copy_only=False).view(np.uint64)
        place = {rep: i for i, rep in enumerate(sets.column("rep").to_pylist())}
        a, b = [], []
        for x, y in zip(here.column("a").to_pylist(), here.column("b").to_pylist(), strict=True):
            i, j = place[x], place[y]
            both = np.concatenate((values[ends[i] : ends[i + 1]], values[ends[j] : ends[j + 1]]))
            both.sort(kind="stable")
            shared = int((both[1:] == both[:-1]).sum())
            if 100 * shared >= percent * (len(both) - shared):
                a.append(x)
                b.append(y)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    wanted = tiled.select(*_TILE, F.explode(F.array("a", "b")).alias("rep")).distinct()
    sets = _sets_of_tiles(wanted, stands, docs, k).groupBy(*_TILE)
    return sets.cogroup(tiled.groupBy(*_TILE)).applyInArrow(compare, "a bigint, b bigint")


def similar_groups(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", k: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """``doc_id, n_shingles, component_id``, a row per row of ``docs``.

    Texts link when their shingle sets have a Jaccard similarity of at least
    ``percent`` in a hundred; ``component_id`` is the smallest key reachable.
    A null or blank text has no shingles and only itself; a row without key has
    size and no component, and links nothing; repeated rows are in one
    component; of a key with several texts each text has its own component.
    """
    docs = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    frequent = frequent_shingles(docs, k)
    table = materialise(points(docs, frequent, k, percent), "jaccard-points")
    keyed = table.filter(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    sets = materialise(keyed.groupBy("set_id").agg(F.min("row_id").alias("rep"), F.min("doc_id").alias("least_id")), "jaccard-sets")
    # The row that stands for each set, with its own document.
    standing = small_side(sets.select(F.col("rep").alias("row_id")), "jaccard-standing", COPIED_ROWS)
    stands = materialise(
        keyed.join(standing, "row_id", "left_semi")
        .select(F.col("row_id").alias("rep"), "doc_id", "set_id", "n", "branches", "marks", "counts"),
        "jaccard-stands",
    )
    links = _links(stands, docs, k, percent)
    found = components(links)
    named = sets.join(found, sets["rep"] == found["node"], "left").select(
        "set_id", "least_id", F.coalesce("component", "rep").alias("component")
    )
    least = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    classes = named.join(least, "component").select("set_id", "component_id")
    return table.select("doc_id", "n", "set_id").join(classes, "set_id", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    )


def keep_one(docs: DataFrame, *, key: str = "doc_id", text: str = "text", k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row of each component, that of the smallest key, with all its columns.

    Rows without key stay. Of repeated rows of a key one stays; a key with
    several texts stays with each of them if one of them does.
    """
    groups = similar_groups(docs, key=key, text=text, k=k, percent=percent)
    kept = materialise(
        groups.filter("doc_id = component_id").groupBy(F.col("doc_id").alias("_kept")).agg(F.count("*").alias("_copies")), "jaccard-kept"
    )
    joined = docs.join(small_side(kept, "jaccard-kept-ids", COPIED_ROWS), F.col(key).cast("bigint") == F.col("_kept"))
    if kept.filter("_copies > 1").isEmpty():
        stay = joined.select(*docs.columns)
    else:
        once = joined.filter("_copies = 1").select(*docs.columns)
        stay = once.unionByName(joined.filter("_copies > 1").dropDuplicates([key, text]).select(*docs.columns))
    keyless = docs.filter(F.col(key).isNull())
    return stay if keyless.isEmpty() else stay.unionByName(keyless)


def _unshared_fit(percent: int) -> Column:
    """The two sets may be similar, seen from their first shingles.

    Of those of one set that come before the last one of the other, the ones
    that aren't common are no members of the other at all.
    """
    met = lambda x, y: (
        f"((first_{x} * size(filter(marks_{x}, v -> v <= element_at(marks_{y}, -1))) + {MARKS - 1}) div {MARKS})"
    )
    both = "size(array_intersect(branches_a, branches_b))"
    return F.expr(f"{100 + percent} * ({met('a', 'b')} + {met('b', 'a')} - 2 * {both}) <= {100 - percent} * (n_a + n_b)")


class _Index:
    """The branches that sets share, and the tests that a pair of sets has to pass."""

    def __init__(self, stands: DataFrame, docs: DataFrame, k: int, percent: int):
        self.stands, self.docs, self.k, self.percent = stands, docs, k, percent
        leaves = stands.select("rep", "n", F.explode("branches").alias("branch"))
        shared = leaves.groupBy("branch").agg(F.min("rep").alias("pivot"), F.count("*").alias("members")).filter("members > 1")
        shared = shared.join(self.column("pivot", n="pivot_n"), "pivot")
        self.members = materialise(leaves.join(shared, "branch"), "jaccard-members")
        own = self.members.groupBy("rep").agg(F.collect_list("branch").alias("shared"))
        self.rarest: DataFrame | None = None
        self.edges = materialise(
            stands.join(own, "rep").select("rep", "n", F.size("branches").alias("first"), "marks", F.col("shared").alias("branches")),
            "jaccard-edges",
        )

    def column(self, key: str, **columns: str) -> DataFrame:
        return self.stands.select(F.col("rep").alias(key), *[F.col(c).alias(name) for c, name in columns.items()])

    def _side(self, c: str) -> DataFrame:
        return self.edges.select(F.col("rep").alias(c), *[F.col(x).alias(f"{x}_{c}") for x in ("n", "first", "marks", "branches")])

    def links(self, pairs: DataFrame, name: str) -> DataFrame:
        """The links among distinct ``pairs`` (``a``, ``b``)."""
        near = (
            pairs.join(self._side("a"), "a").join(self._side("b"), "b")
            .filter(_fits("n_a", "n_b", self.percent)).filter(_unshared_fit(self.percent))
            .select("a", "b", "n_a", "n_b")
        )
        near = materialise(near, f"jaccard-near-{name}")
        bounded = (
            near.join(self.column("a", counts="c_a"), "a").join(self.column("b", counts="c_b"), "b")
            .filter(_bounded("c_a", "c_b", "n_a", "n_b", self.percent))
            .select("a", "b")
        )
        pairs = materialise(bounded, f"jaccard-pairs-{name}")
        return materialise(_verified(pairs, self.stands, self.docs, self.k, self.percent), f"jaccard-links-{name}")

    def mixed(self, links: DataFrame) -> DataFrame:
        """Members of branches that hold several components, with the largest one.

        In a first branch of two the pivot was all there was to compare with.
        """
        found = components(links)
        small = self.members.filter(F.col("members").between(3, PAGE)).withColumn("own", F.lit(0).cast("bigint"))
        if self.rarest is None:
            large = self.members.filter(F.col("members") > PAGE).withColumn("own", F.lit(0).cast("bigint"))
        else:
            # Sets that have new branches meet each other in those.
            small = small.join(self.led, "rep", "left")
            large = self.rarest
        again = F.col("led") if self.rarest is not None else F.lit(None).cast("boolean")
        columns = ["branch", "rep", "n", "own", "members"]
        small = small.select(*columns, F.coalesce(again, F.lit(False)).alias("led"))
        large = large.select(*columns, F.lit(False).alias("led"))
        placed = materialise(
            small.unionByName(large)
            .join(found, F.col("rep") == F.col("node"), "left")
            .select("branch", "rep", F.col("n").alias("n_rep"), "own", "members", "led", F.coalesce("component", "rep").alias("component")),
            "jaccard-placed",
        )
        largest = (
            placed.groupBy("branch", "component")
            .agg(F.count("*").alias("own"))
            .groupBy("branch")
            .agg(F.max_by("component", F.struct("own", "component")).alias("largest"), F.count("*").alias("different"))
            .filter("different > 1")
            .drop("different")
        )
        return materialise(placed.join(largest, "branch"), "jaccard-mixed")


    def replace_large(self, mixed: DataFrame) -> None:
        """Lead the sets of large branches to new ones, by their rarest shingles.

        Whoever is similar to a set by a large branch is in one, too. Among these
        sets all shingles are counted, so that the first ones in the order are the
        rarest: a near copy with many changes leaves the branches of its group.
        Similar sets that share a rare shingle meet in the branch of one. In other
        branches ``own`` therefore counts the rare shingles of a set: of sets that
        only meet there, they are part of no overlap.
        """
        sets = materialise(mixed.filter(F.col("members") > PAGE).select("rep").distinct(), "jaccard-led")
        self.led = sets.withColumn("led", F.lit(True))
        asked = (
            sets.join(self.stands.select("rep", "doc_id", "set_id"), "rep")
            .groupBy("doc_id").agg(F.collect_list(F.struct("set_id", "rep")).alias("asked"))
        )
        found = materialise(_shingles(self.docs, asked, self.k), "jaccard-large").select("rep", F.explode("shingles").alias("shingle"))
        often = found.groupBy("shingle").agg(F.count("*").alias("sets"))
        ordered = (
            found.join(often, "shingle").groupBy("rep")
            .agg(F.array_sort(F.collect_set(F.struct("sets", "shingle"))).alias("shingles"), F.count_if(F.col("sets") == 1).alias("only"), F.count_if(F.col("sets") <= RARE).alias("rare"))
            .join(self.column("rep", n="n"), "rep")
            .filter(f"100 * (n - only) >= {self.percent} * n")
        )
        first = F.expr(f"slice(shingles, 1, cast(n - ceil({self.percent} * n / 100) + 1 as int))")
        leaves = materialise(
            ordered.select("rep", "n", "rare", F.explode(first).alias("leaf"))
            .select("rep", "n", F.expr(f"if(leaf.sets > {RARE}, rare, 0)").alias("own"), F.expr("leaf.shingle | (-9223372036854775807 - 1)").alias("branch"), F.col("leaf.sets").alias("sets"))
            .filter("sets > 1"),
            "jaccard-rarest-leaves",
        )
        members = leaves.groupBy("branch").agg(F.count("*").alias("members")).filter("members > 1")
        self.rarest = materialise(leaves.join(members, "branch"), "jaccard-rarest")


def _ordered(pairs: DataFrame, x: str, y: str) -> DataFrame:
    return pairs.select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).distinct()


def _links(stands: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    index = _Index(stands, docs, k, percent)
    to_pivots = index.members.filter("rep != pivot").filter(_fits("n", "pivot_n", percent))
    decided = materialise(_ordered(to_pivots, "rep", "pivot"), "jaccard-to-pivots")
    links = index.links(decided, "pivots")

    # Sets outside the largest component of a large branch then meet those of its members that have
    # least of their own: in a group of near copies, what is similar to any mostly is to these.
    index.replace_large(index.mixed(links))
    mixed = index.mixed(links)
    mates = (
        mixed.filter((F.col("members") > PAGE) & F.expr("component = largest"))
        .groupBy("branch", F.expr(f"pmod(xxhash64(rep, 7), {MATES})").alias("share"))
        .agg(F.min_by(F.struct("rep", "n_rep"), F.struct("own", "rep")).alias("m"))
        .select("branch", F.col("m.rep").alias("mate"), F.col("m.n_rep").alias("n_mate"))
    )
    to_mates = _outside(mixed).join(mates, "branch").filter(_fits("n_o", "n_mate", percent))
    to_mates = materialise(_ordered(to_mates, "o", "mate").join(decided, ["a", "b"], "left_anti"), "jaccard-to-mates")
    links = links.unionByName(index.links(to_mates, "mates"))
    decided = decided.unionByName(to_mates)

    mixed = index.mixed(links)
    links = links.unionByName(_linked_in_pages(mixed.filter(F.col("members") > PAGE), index, percent))
    met = _met_in_leaves(mixed.filter(F.col("members") <= PAGE), percent)
    rest = materialise(_ordered(met, "o", "rep").join(decided, ["a", "b"], "left_anti"), "jaccard-rest")
    return links.unionByName(index.links(rest, "rest"))


def _outside(mixed: DataFrame) -> DataFrame:
    return mixed.filter("component != largest").select("branch", F.col("rep").alias("o"), F.col("component").alias("outer"), F.col("n_rep").alias("n_o"), F.col("own").alias("own_o"), F.col("led").alias("led_o"))


# Of two sets outside the largest component one descends, and it meets only other components.
_DESCENDS = "outer != component and not (led and led_o) and (component = largest or rep > o)"


def _met_in_leaves(mixed: DataFrame, percent: int) -> DataFrame:
    """Pairs of a branch that is one page: a set outside meets the branch's sets."""
    return _outside(mixed).join(mixed, "branch").filter(_DESCENDS).filter(_fits("n_o", "n_rep", percent)).select("o", "rep")


def _linked_in_pages(mixed: DataFrame, index: _Index, percent: int) -> DataFrame:
    """Links of larger branches: a set outside visits the pages that its point can share enough with.

    Branches of one group of near copies have the same largest component, so
    their sets are one list of pages, and a pair is met once and not in each of
    its branches. ``own`` is the least of a set's branches there. No pair is
    listed: a row is a visit to a page, and pages of one block meet their
    visitors, ``BLOCK`` at a time, in one task that compares whole sets.
    """
    listed = (
        mixed.groupBy("largest", "rep")
        .agg(*[F.first(c).alias(c) for c in ("n_rep", "component", "led")], F.min("own").alias("own"))
        .withColumn("branch", F.col("largest"))
    )
    sizes = listed.groupBy("branch").agg(F.count("*").alias("members"), F.count_if(F.col("component") != F.col("branch")).alias("outside"))
    tiled = listed.join(sizes, "branch").select(
        "branch", "rep", "n_rep", "own", "component", "led",
        F.expr(f"cast(pmod(xxhash64(rep), ceil(members / {BLOCK})) as int)").alias("block"),
        F.expr(f"cast(floor(ln(n_rep) / ln(1.1)) as int) * {max(1, BLOCK // PAGE)} + cast(pmod(xxhash64(rep, 3), {max(1, BLOCK // PAGE)}) as int)").alias("page"),
        F.expr(f"cast(pmod(xxhash64(rep, 5), ceil(outside / {BLOCK})) as int)").alias("part"),
    )
    tiled = materialise(tiled, "jaccard-pages")
    pages = tiled.join(index.column("rep", counts="c_rep"), "rep").groupBy("branch", "block", "page").agg(
        F.min("n_rep").alias("n_least"), F.max("n_rep").alias("n_most"), F.min("own").alias("own_least"),
        F.array(*[F.max(F.col("c_rep")[i]) for i in range(GROUPS)]).alias("c_page"),
    )
    near = F.expr(f"100 * n_rep >= {percent} * n_least and 100 * n_most >= {percent} * n_rep")
    outer = ["n_rep", "own", "component", "led"]
    visits = (
        tiled.filter("component != branch").select("branch", "rep", "part", *outer)
        .join(index.column("rep", counts="c_rep"), "rep").join(pages, "branch").filter(near)
        .filter(f"{100 + percent} * (own + own_least) <= {100 - percent} * (n_rep + n_most)")
        .filter(_bounded("c_rep", "c_page", "n_rep", "n_least", percent))
        .groupBy(F.col("branch").alias("family"), F.col("block").alias("lo"), F.col("part").alias("hi"), "rep", *outer)
        .agg(F.collect_list("page").alias("pages"))
    )
    visits = materialise(visits, "jaccard-visits")
    visited = visits.select(*_TILE).distinct()
    members = tiled.select(F.col("branch").alias("family"), F.col("block").alias("lo"), "rep", *outer, F.array("page").alias("pages"))
    members = members.join(visited, ["family", "lo"])
    rows = members.withColumn("visits", F.lit(False)).unionByName(visits.withColumn("visits", F.lit(True)))
    rows = materialise(rows, "jaccard-visited")

    def compare(sets: pa.Table, here: pa.Table) -> pa.Table:
        lists = sets.column("shingles").combine_chunks()
        ends, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
        place = {rep: i for i, rep in enumerate(sets.column("rep").to_pylist())}
        shingles = lambda rep: values[ends[place[rep]] : ends[place[rep] + 1]].view(np.uint64)
        rows = here.to_pylist()
        held = [r for r in rows if not r["visits"]]
        rep, n, own, component, led = (np.array([r[c] for r in held]) for c in ("rep", *outer))
        page = np.array([r["pages"][0] for r in held])
        owner = np.repeat(np.arange(len(held)), [len(shingles(r)) for r in rep.tolist()])
        every = np.concatenate([shingles(r) for r in rep.tolist()])
        a, b = [], []
        for r in rows:
            if not r["visits"]:
                continue
            # Of two sets outside the largest component one descends, and it meets only other components.
            ask = np.isin(page, r["pages"]) & (component != r["component"]) & ~(led & r["led"])
            ask &= (component == r["family"]) | (rep > r["rep"])
            ask &= 100 * np.minimum(n, r["n_rep"]) >= percent * np.maximum(n, r["n_rep"])
            ask &= (100 + percent) * (own + r["own"]) <= (100 - percent) * (n + r["n_rep"])
            if not ask.any():
                continue
            mine = shingles(r["rep"])
            asked = ask[owner]
            found = every[asked]
            at = np.minimum(np.searchsorted(mine, found), len(mine) - 1)
            shared = np.bincount(owner[asked][mine[at] == found], minlength=len(held))
            for other in rep[ask & (100 * shared >= percent * (n + r["n_rep"] - shared))].tolist():
                a.append(max(other, r["rep"]))
                b.append(min(other, r["rep"]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    sets = _sets_of_tiles(rows.select(*_TILE, "rep").distinct(), index.stands, index.docs, index.k)
    links = sets.groupBy(*_TILE).cogroup(rows.groupBy(*_TILE)).applyInArrow(compare, "a bigint, b bigint")
    return materialise(links, "jaccard-links-pages")
