"""Words of UTF-8 texts and 64-bit hashes of them, with numpy over whole Arrow batches.

Texts are taken as bytes: all word rules of this package separate words at
ASCII characters and lower-case A-Z only, so no text is decoded.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

# Bytes of text that are worked on at a time, unless one text is longer.
SLICE_BYTES = 1 << 19

# Fixed odd multipliers; any others would do, but hashes are stored.
_BASE = 0x9E3779B97F4A7C15
_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Words are runs without blanks: ``[^\x20\x09-\x0D]+``.
NOT_BLANK = np.ones(256, dtype=bool)
NOT_BLANK[[0x20, *range(0x09, 0x0E)]] = False
#: Words are runs of digits, letters and everything beyond ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


class Slice(NamedTuple):
    """Neighbouring texts of a batch: the first one's row, their bytes, and where each begins and ends."""

    first: int
    data: np.ndarray
    bounds: np.ndarray


class Words(NamedTuple):
    text: np.ndarray  # row within the slice
    start: np.ndarray  # first byte
    end: np.ndarray  # byte after the last
    hash: np.ndarray


def mix(h: np.ndarray) -> np.ndarray:
    """Scatter the bits of uint64 values."""
    h = (h ^ (h >> np.uint64(30))) * _MIX_1
    h = (h ^ (h >> np.uint64(27))) * _MIX_2
    return h ^ (h >> np.uint64(31))


def slices(texts: pa.Array, slice_bytes: int = SLICE_BYTES) -> Iterator[Slice]:
    """Cut a column of strings (null: empty) into slices of about ``slice_bytes``."""
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        to = int(np.searchsorted(bounds, bounds[at] + slice_bytes, side="right")) - 1
        to = min(max(to, at + 1), len(texts))
        yield Slice(at, raw[bounds[at] : bounds[to]], bounds[at : to + 1] - bounds[at])
        at = to


class _Powers:
    """Powers of the base and of its inverse, as many as the longest slice needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, SLICE_BYTES)
            step = np.full(n, _BASE, dtype=np.uint64)
            back = np.full(n, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
            step[0] = back[0] = 1
            self.up, self.down = np.multiply.accumulate(step), np.multiply.accumulate(back)
        return self.up, self.down


_powers = _Powers()


class Hashed:
    """A slice with a prefix sum that gives the hash of any run of its bytes."""

    def __init__(self, part: Slice, fold_latin: bool = False):
        """``fold_latin``: capital letters of the Latin-1 block count as small ones, too."""
        self.part = part
        n = len(part.data)
        up, self.down = _powers(n + 1)
        lower = LOWER[part.data]
        if fold_latin and n:
            d = part.data
            capital = (d[1:] >= 0x80) & (d[1:] <= 0x9E) & (d[1:] != 0x97) & (d[:-1] == 0xC3)
            lower[1:][capital] += 0x20
        terms = lower.astype(np.uint64)
        terms += np.uint64(1)
        terms *= up[:n]
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(terms, out=self.sums[1:])

    def runs(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])

    def words(self, inside: np.ndarray) -> Words:
        """Maximal runs of bytes for which ``inside`` holds; A-Z counts as a-z."""
        data, bounds = self.part.data, self.part.bounds
        is_word = np.zeros(len(data) + 2, dtype=bool)
        is_word[1:-1] = inside[data]
        begins = is_word[1:-1] & ~is_word[:-2]
        ends = is_word[1:-1] & ~is_word[2:]
        edges = bounds[1:-1]
        edges = edges[(edges > 0) & (edges < len(data))]
        begins[edges] = is_word[1:-1][edges]
        ends[edges - 1] = is_word[1:-1][edges - 1]
        start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        text = np.searchsorted(bounds, start, side="right") - 1
        return Words(text, start, end, self.runs(start, end))


def grams(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of the first word, and hash, of every run of ``k`` words of one text."""
    n = len(words.hash) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total = np.full(n, k, dtype=np.uint64)
    for j in range(k):
        total = (total + words.hash[j : j + n]) * np.uint64(_BASE)
        total ^= total >> np.uint64(29)
    at = np.flatnonzero(words.text[:n] == words.text[k - 1 :])
    return at, mix(total[at])


def text_words(text: str, inside: np.ndarray) -> Words:
    """Words of one text."""
    (part,) = slices(pa.array([text]))
    return Hashed(part).words(inside)
