"""Quality classifier: ordinal cumulative-link regression on graded ratings.

One weight per hashed text feature gives a text a latent score ``s``; ordered
thresholds ``t_1 < t_2 < ...`` cut it into grades: P(grade >= k) is the logistic
function of ``s - t_k``. All grades share the weights. Reported are the expected
grade and the tail probability of the grade that selection asks for.

Features are shares of a text's words: the word, the marks around it, its
letter case, all hashed into buckets; and, as one bucket each, its length and how
often it repeats itself. A text's score is a sum over its words, so that scoring
is one pass without a shuffle, whatever the length of the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from corpuscle.llm import hashing
from corpuscle.llm.labelled import labelled_sample
from corpuscle.llm.memory import giving_back

# Bounds of the fit: rated rows, and buckets of hashed features.
TRAINING_ROWS = 8192
BUCKETS = 1 << 12
STEPS = 400
RATE = 0.3
RIDGE = 1e-5
# Words of a repeated run, and the steps in which the share of distinct runs counts.
RUN = 3
RUN_STEPS = 10

_CAPITALS, _MARKS, _PLAIN = np.uint64(0xA1), np.uint64(0xB3), np.uint64(0xC5)


@dataclass
class Model:
    """Weights by bucket and ordered thresholds; ``grades`` is their number plus one."""

    weights: np.ndarray
    thresholds: np.ndarray

    @property
    def grades(self) -> int:
        return len(self.thresholds) + 1


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def features(part: hashing.Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket, value) of a slice, with repetitions; the values of a bucket add up."""
    n = len(part.bounds) - 1
    hashed = hashing.Hashed(part)
    tokens = hashed.words(hashing.NOT_BLANK)
    words = hashed.words(hashing.ALNUM)
    per_token = 1.0 / np.maximum(1, np.bincount(tokens.text, minlength=n))
    per_word = 1.0 / np.maximum(1, np.bincount(words.text, minlength=n))
    # Marks at the end of a token: what follows its last letter or digit.
    is_mark = ~hashing.ALNUM[part.data]
    last_letter = np.maximum.accumulate(np.where(is_mark, -1, np.arange(len(part.data)))) if len(part.data) else np.zeros(0, np.int64)
    marks_from = np.maximum(tokens.start, last_letter[tokens.end - 1] + 1) if len(tokens.end) else tokens.start
    marks = hashing.mix(hashed.runs(marks_from, tokens.end) ^ _MARKS)
    upper = np.concatenate([[0], np.cumsum((part.data >= 65) & (part.data <= 90))])
    lower = np.concatenate([[0], np.cumsum((part.data >= 97) & (part.data <= 122))])
    shouted = (upper[tokens.end] - upper[tokens.start] > 1) & (lower[tokens.end] == lower[tokens.start])
    capitals = hashing.mix(shouted.astype(np.uint64) ^ _CAPITALS)
    texts = [words.text, tokens.text, tokens.text]
    buckets = [_bucket(words.hash), _bucket(marks), _bucket(capitals)]
    values = [per_word[words.text], per_token[tokens.text], per_token[tokens.text]]
    # Plain facts of a text, one bucket each.
    at, gram = hashing.grams(words, RUN)
    owner = words.text[at]
    key, first = np.unique(hashing.mix(gram + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
    all_runs, distinct = np.bincount(owner, minlength=n), np.bincount(owner[first], minlength=n)
    share = np.floor(RUN_STEPS * distinct / np.maximum(1, all_runs)).astype(np.uint64)
    size = np.floor(np.log2(1 + np.bincount(tokens.text, minlength=n))).astype(np.uint64)
    for tag, fact in ((1, share), (2, size)):
        texts.append(np.arange(n))
        buckets.append(_bucket(hashing.mix(fact * np.uint64(16) + np.uint64(tag) ^ _PLAIN)))
        values.append(np.full(n, 0.5))
    return np.concatenate(texts), np.concatenate(buckets), np.concatenate(values)


def latent(texts: pa.Array, model: Model) -> np.ndarray:
    """The latent score of each text."""
    out = np.zeros(len(texts))
    for part in hashing.slices(texts):
        n = len(part.bounds) - 1
        owner, bucket, value = features(part)
        out[part.first : part.first + n] = np.bincount(owner, weights=value * model.weights[bucket], minlength=n)
    return out


def tails(scores: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """P(grade >= k) for k = 1, 2, ...; a row per score."""
    return 1 / (1 + np.exp(-np.clip(scores[:, None] - thresholds[None, :], -30, 30)))


def fit_rows(rows: np.ndarray, buckets: np.ndarray, values: np.ndarray, grades: np.ndarray, n_grades: int) -> Model:
    """Maximum likelihood with a ridge, by gradient steps of adapted length.

    Thresholds are the first one and positive steps, so they stay ordered.
    """
    n = len(grades)
    w, gaps = np.zeros(BUCKETS), np.zeros(n_grades - 1)
    reached = np.array([(grades >= k).mean() for k in range(1, n_grades)])
    start = -np.log(np.clip(reached, 1e-3, 1 - 1e-3) / (1 - np.clip(reached, 1e-3, 1 - 1e-3)))
    gaps[0] = start[0]
    gaps[1:] = np.log(np.expm1(np.maximum(np.diff(start), 1e-2)))
    moments = [np.zeros(BUCKETS), np.zeros(BUCKETS), np.zeros(n_grades - 1), np.zeros(n_grades - 1)]
    for step in range(1, STEPS + 1):
        thresholds = _thresholds(gaps)
        s = np.bincount(rows, weights=values * w[buckets], minlength=n)
        above = np.hstack([np.ones((n, 1)), tails(s, thresholds), np.zeros((n, 1))])
        upper, lower = above[np.arange(n), grades], above[np.arange(n), grades + 1]
        # d log(upper - lower) / d s, and with respect to the thresholds.
        p = np.maximum(upper - lower, 1e-9)
        d_upper, d_lower = upper * (1 - upper) / p, lower * (1 - lower) / p
        g_w = -np.bincount(buckets, weights=values * (d_upper - d_lower)[rows], minlength=BUCKETS) / n + RIDGE * w
        g_t = np.zeros(n_grades - 1)
        np.add.at(g_t, np.maximum(grades - 1, 0), np.where(grades > 0, d_upper, 0) / n)
        np.add.at(g_t, np.minimum(grades, n_grades - 2), np.where(grades < n_grades - 1, -d_lower, 0) / n)
        through = np.cumsum(g_t[::-1])[::-1]
        g_gaps = through * np.concatenate([[1.0], 1 / (1 + np.exp(-gaps[1:]))])
        rate = RATE * min(1.0, 2 * (1 - step / (STEPS + 1)))
        for value, gradient, i in ((w, g_w, 0), (gaps, g_gaps, 2)):
            moments[i] = 0.9 * moments[i] + 0.1 * gradient
            moments[i + 1] = 0.99 * moments[i + 1] + 0.01 * gradient**2
            value -= rate * (moments[i] / (1 - 0.9**step)) / (np.sqrt(moments[i + 1] / (1 - 0.99**step)) + 1e-5)
    return Model(w, _thresholds(gaps))


def _thresholds(gaps: np.ndarray) -> np.ndarray:
    return np.cumsum(np.concatenate([gaps[:1], np.log1p(np.exp(gaps[1:]))]))


def fit(
    docs: DataFrame, ratings: DataFrame, grade: Column, n_grades: int, *,
    rows: int = TRAINING_ROWS, key: str = "doc_id", text: str = "text",
) -> Model:
    """Fit on at most ``rows`` rated rows that are not held out; ``grade`` counts from 0.

    Grades outside 0 .. ``n_grades - 1`` and null ones are left out. Without
    rated rows every text has score 0, and every tail the probability one half
    or above, so that nothing is rejected for want of ratings.
    """
    sample = labelled_sample(docs, ratings, F.when(grade.between(0, n_grades - 1), grade), rows, key, text)

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in hashing.slices(batch.column(0)):
                n = len(part.bounds) - 1
                owner, bucket, value = features(part)
                summed, place = np.unique(owner * BUCKETS + bucket, return_inverse=True)
                total = np.bincount(place, weights=value, minlength=len(summed))
                ends = np.searchsorted(summed // BUCKETS, np.arange(n + 1)).astype(np.int32)
                yield pa.record_batch(
                    [
                        batch.column(1).slice(part.first, n), batch.column(2).slice(part.first, n),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array((summed % BUCKETS).astype(np.int16))),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(total.astype(np.float32))),
                    ],
                    names=["doc_id", "grade", "buckets", "values"],
                )

    # Bounded: at most ``rows`` rows of at most ``BUCKETS`` small numbers each.
    table = sample.select("text", "doc_id", "label").mapInArrow(giving_back(collect), "doc_id bigint, grade int, buckets array<smallint>, values array<float>")
    table = table.orderBy("doc_id").toArrow()
    grades = table.column("grade").to_numpy().astype(np.int64)
    if not len(grades):
        return Model(np.zeros(BUCKETS), np.arange(n_grades - 1, dtype=np.float64) - (n_grades - 1))
    flat = lambda c: np.concatenate([x.flatten().to_numpy(zero_copy_only=False) for x in table.column(c).chunks])
    sizes = np.concatenate([x.value_lengths().to_numpy(zero_copy_only=False) for x in table.column("buckets").chunks])
    owner = np.repeat(np.arange(len(grades)), sizes)
    return fit_rows(owner, flat("buckets").astype(np.int64), flat("values").astype(np.float64), grades, n_grades)


def score(docs: DataFrame, model: Model, *, select: int = 1, keep_from: float = 0.5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, expected_grade, tail, keep`` of whole texts, a row per row.

    ``tail`` is the probability of grade ``select`` or a higher one, ``keep``
    whether it reaches ``keep_from``. A null or empty text is judged by its
    length and repetition alone; repeated rows have equal scores; null keys are
    rows of their own; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            above = tails(latent(batch.column(1), model), model.thresholds)
            tail = above[:, select - 1]
            yield pa.record_batch(
                [batch.column(0), pa.array(above.sum(axis=1)), pa.array(tail), pa.array(tail >= keep_from)],
                names=["doc_id", "expected_grade", "tail", "keep"],
            )

    narrow = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return narrow.mapInArrow(giving_back(run), "doc_id bigint, expected_grade double, tail double, keep boolean")


def keep_good(docs: DataFrame, model: Model, *, select: int = 1, keep_from: float = 0.5, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``score`` keeps, with all their columns."""

    @arrow_udf("boolean")
    def good(texts: pa.Array) -> pa.Array:
        return pa.array(tails(latent(texts, model), model.thresholds)[:, select - 1] >= keep_from)

    return docs.filter(good(F.col(text)))
