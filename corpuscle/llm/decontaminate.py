"""Benchmark decontamination by pigeonhole edit matching.

Texts are compared as words (A-Z lower-cased, punctuation apart). An item of
``n`` words may have ``errors_percent`` of them inserted, missing or changed.
It is split into one piece more than that budget: where the item stands, at
least one piece stands unchanged. Piece hits are found by rolling word hashes
and verified on the text around them with Myers' bit-parallel distance.

Items are sent to the tasks that scan the documents, in blocks of a bounded
number of words; documents are not shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from corpuscle.llm import hashing
from corpuscle.llm.memory import giving_back
from corpuscle.sources.shared import materialise

ERRORS_PERCENT = 20
# Items of fewer words have no error budget. With ``short_within`` they are one exact
# piece and found anywhere; else they match only documents that consist of them.
LEAST_WORDS = 6
# Words of the items that are sent to the tasks at a time.
BLOCK_WORDS = 2_000_000

HITS = "doc_id bigint, item_id bigint, n_errors int, error_budget int, first_word bigint, last_word bigint, n_item_words int"
_HIT_TYPES = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32())


def best_end(pattern: list[int], text: list[int]) -> tuple[int, int]:
    """Least edit distance of ``pattern`` to a run of ``text``, and where the first such run ends."""
    m = len(pattern)
    mask = (1 << m) - 1
    places: dict[int, int] = {}
    for i, word in enumerate(pattern):
        places[word] = places.get(word, 0) | 1 << i
    up, down, distance = mask, 0, m
    best, end = m, 0
    top = 1 << (m - 1)
    for j, word in enumerate(text):
        equal = places.get(word, 0)
        vertical = equal | down
        equal |= ((equal & up) + up ^ up) & mask
        plus, minus = down | ~(equal | up) & mask, up & equal
        distance += bool(plus & top) - bool(minus & top)
        plus, minus = plus << 1 & mask, minus << 1 & mask
        up, down = (minus | ~(vertical | plus)) & mask, plus & vertical
        if distance < best:
            best, end = distance, j + 1
    return best, end


def place(pattern: list[int], text: list[int]) -> tuple[int, int, int]:
    """Least distance, and the run ``text[start:end]`` that has it: the first to end, and of those the shortest."""
    best, end = best_end(pattern, text)
    _, back = best_end(pattern[::-1], text[:end][::-1])
    return best, end - back, end


def _key(run: np.ndarray) -> int:
    """The rolling hash of all words of a run."""
    return int(hashing.grams(hashing.Words(np.zeros(len(run), np.int64), run, run, run), len(run))[1][0])


class Items:
    """Word hashes of a block of items, and where their pieces stand."""

    def __init__(self, rows: list[tuple[int, str | None]], errors_percent: int, short_within: bool = False):
        self.ids = [row[0] for row in rows]
        self.words: list[list[int]] = []
        self.budgets: list[int] = []
        self.whole: dict[int, list[int]] = {}
        self.short_within = short_within
        short: dict[int, dict[int, list[int]]] = {}
        pieces: dict[int, dict[int, list[tuple[int, int]]]] = {}
        texts = pa.array([row[1] or "" for row in rows], pa.string())
        for part in hashing.slices(texts):
            words = hashing.Hashed(part).words(hashing.ALNUM)
            ends = np.searchsorted(words.text, np.arange(len(part.bounds)))
            for a, b in zip(ends, ends[1:], strict=False):
                self._add(words, int(a), int(b), errors_percent, pieces)
        self.keys = {k: np.array(sorted(found), dtype=np.uint64) for k, found in pieces.items()}
        self.pieces = pieces
        for n, numbers in self.whole.items() if short_within else ():
            for number in numbers:
                short.setdefault(n, {}).setdefault(_key(np.array(self.words[number], np.uint64)), []).append(number)
        self.short = short
        self.short_keys = {n: np.array(sorted(found), dtype=np.uint64) for n, found in short.items()}

    def _add(self, words: hashing.Words, a: int, b: int, errors_percent: int, pieces: dict) -> None:
        number, n = len(self.words), b - a
        own = words.hash[a:b]
        self.words.append(own.tolist())
        self.budgets.append(n * errors_percent // 100 if n >= LEAST_WORDS else 0)
        if n < LEAST_WORDS:
            if n:
                self.whole.setdefault(n, []).append(number)
            return
        cuts = np.linspace(0, n, self.budgets[-1] + 2).astype(int)
        for start, end in zip(cuts, cuts[1:], strict=False):
            run = own[start:end]
            pieces.setdefault(len(run), {}).setdefault(_key(run), []).append((number, int(start)))

    def search(self, texts: pa.Array) -> Iterator[tuple[int, int, int, int, int]]:
        """(row, item, errors, first word, last word) of the best place of every item in every text."""
        for part in hashing.slices(texts):
            words = hashing.Hashed(part).words(hashing.ALNUM)
            n_texts = len(part.bounds) - 1
            first = np.searchsorted(words.text, np.arange(n_texts + 1))
            places: dict[int, set[tuple[int, int]]] = {}
            for k, keys in self.keys.items():
                at, gram = hashing.grams(words, k)
                hit = keys[np.minimum(np.searchsorted(keys, gram), len(keys) - 1)] == gram
                for i, g in zip(at[hit].tolist(), gram[hit].tolist(), strict=True):
                    for number, start in self.pieces[k][g]:
                        places.setdefault(int(words.text[i]), set()).add((number, i - start))
            sizes = np.diff(first)
            yield from self._short(part.first, words, first)
            for n, numbers in () if self.short_within else self.whole.items():
                for row in np.flatnonzero(sizes == n).tolist():
                    own = words.hash[first[row] : first[row + 1]].tolist()
                    yield from ((part.first + row, i, 0, 0, n - 1) for i in numbers if self.words[i] == own)
            for row, found in sorted(places.items()):
                yield from self._verified(part.first + row, words.hash, int(first[row]), int(first[row + 1]), found)

    def _short(self, row: int, words: hashing.Words, first: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """The first place of every short item in every text of a slice that starts at ``row``."""
        for n, keys in self.short_keys.items():
            at, gram = hashing.grams(words, n)
            hit = keys[np.minimum(np.searchsorted(keys, gram), len(keys) - 1)] == gram
            at, gram = at[hit], gram[hit]
            # A frequent word may be an item: of its places in a text only the first is looked at.
            order = np.lexsort((at, gram, words.text[at]))
            at, gram = at[order], gram[order]
            new = np.ones(len(at), bool)
            new[1:] = (gram[1:] != gram[:-1]) | (words.text[at[1:]] != words.text[at[:-1]])
            for i, g in zip(at[new].tolist(), gram[new].tolist(), strict=True):
                text, own = int(words.text[i]), words.hash[i : i + n].tolist()
                start = i - int(first[text])
                yield from ((row + text, number, 0, start, start + n - 1) for number in self.short[n][g] if self.words[number] == own)

    def _verified(self, row: int, hashes: np.ndarray, begin: int, end: int, found: set[tuple[int, int]]) -> Iterator[tuple]:
        best: dict[int, tuple[int, int, int]] = {}
        done: dict[int, int] = {}
        for number, at in sorted(found):
            budget, pattern = self.budgets[number], self.words[number]
            # A window reaches the budget to both sides, so the next places are in it as well.
            if at <= done.get(number, at - 1):
                continue
            done[number] = at + budget
            low, high = max(begin, at - budget), min(end, at + 2 * budget + len(pattern))
            errors, start, stop = place(pattern, hashes[low:high].tolist())
            if errors <= budget:
                here = (errors, low + start - begin, low + stop - 1 - begin)
                best[number] = min(best.get(number, here), here)
        for number, (errors, start, stop) in sorted(best.items()):
            yield row, number, errors, start, stop


def item_blocks(
    benchmark: DataFrame, errors_percent: int, key: str, text: str, block_words: int, short_within: bool = False,
) -> Iterator[Items]:
    items = materialise(
        benchmark.select(F.col(key).cast("bigint").alias("item_id"), F.col(text).alias("text")).filter("item_id is not null").distinct(),
        "decontaminate-items",
    )
    words = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0] / 5
    blocks = max(1, ceil(words / block_words))
    for number in range(blocks):
        # About ``block_words`` words, however large the benchmark is.
        rows = items.filter(F.expr(f"pmod(xxhash64(item_id, text), {blocks}) = {number}")).orderBy("item_id", "text").collect()
        if rows:
            yield Items([(r["item_id"], r["text"]) for r in rows], errors_percent, short_within)


def find_hits(
    docs: DataFrame, benchmark: DataFrame, *, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
    item_text: str = "text", errors_percent: int = ERRORS_PERCENT, block_words: int = BLOCK_WORDS, short_within: bool = False,
) -> DataFrame:
    """A row per document row and item that stands in it: errors, budget, and the words it takes.

    Of several places the one with fewest errors counts, then the first. Null
    and empty texts match nothing, nor do items without words or key; repeated
    document rows give repeated rows, a null key is kept; of an item key with
    several texts each text is an item; other columns are ignored. ``short_within``:
    find items of fewer than ``LEAST_WORDS`` words anywhere, not only as whole texts.
    """
    narrow = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))

    def hits(items: Items) -> DataFrame:
        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keys = batch.column(0)
                rows = [
                    (keys[row].as_py(), items.ids[i], errors, items.budgets[i], start, stop, len(items.words[i]))
                    for row, i, errors, start, stop in items.search(batch.column(1))
                ]
                columns = list(zip(*rows, strict=True)) or [()] * len(_HIT_TYPES)
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, _HIT_TYPES, strict=True)], names=[c.split()[0] for c in HITS.split(", ")])

        return narrow.mapInArrow(giving_back(scan), HITS)

    parts = [hits(items) for items in item_blocks(benchmark, errors_percent, item_key, item_text, block_words, short_within)]
    return reduce(DataFrame.unionByName, parts) if parts else docs.sparkSession.createDataFrame([], HITS)


def remove_contaminated(
    docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item_key: str = "item_id", item_text: str = "text",
    errors_percent: int = ERRORS_PERCENT, block_words: int = BLOCK_WORDS, short_within: bool = False,
) -> DataFrame:
    """The rows of ``docs`` in which no item stands, with all their columns; items as in ``find_hits``."""
    for items in item_blocks(benchmark, errors_percent, item_key, item_text, block_words, short_within):
        docs = docs.filter(_is_clean(items)(F.col(text)))
    return docs


def _is_clean(items: Items):
    @arrow_udf("boolean")
    def clean(texts: pa.Array) -> pa.Array:
        mask = np.ones(len(texts), dtype=bool)
        mask[[hit[0] for hit in items.search(texts)]] = False
        return pa.array(mask)

    return clean
