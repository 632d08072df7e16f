"""Toxicity by weak supervision.

Many voters look at a text: seed lexicons, patterns, and stems mined from
labelled rows. A generative model (a vote depends on the hidden class; voters
that go together within a class form groups that count as one) is fitted by
expectation maximisation and gives every training text a posterior. A
linear classifier on words and word beginnings is trained on the posteriors and
scores whole texts.

Training sees at most ``TRAINING_ROWS`` labelled rows, none of them held out.
Feature counts are Spark aggregates; the driver gets the few features that
survive a screening. Scoring is one pass over the texts, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from corpuscle.llm import hashing
from corpuscle.llm.labelled import held_out, labelled_sample
from corpuscle.llm.memory import giving_back
from corpuscle.sources.shared import materialise

# Bounds of the fit: labelled rows, screened features, mined voters.
TRAINING_ROWS = 8192
FEATURES = 512
MINED_VOTERS = 48
# A mined voter: share of toxic texts among those that have it, and toxic texts at least.
MINED_PRECISION = 0.95
MINED_LEAST = 4
# Word beginnings in bytes; whole words count besides.
BEGINNINGS = (4, 5, 6, 7)
# Voters whose votes correlate more than this within a class share one voice.
CORRELATED = 0.7
ITERATIONS = 40
RIDGE = 0.5
# Standard deviations by which a feature's share in the classes differs, at least.
SIGNIFICANT = 7.0

# Seed words; each line is a voter.
LEXICONS = (
    ("idiot", "idiots", "moron", "morons", "imbecile", "stupid", "dumb", "fool"),
    ("loser", "losers", "clown", "clowns", "pathetic", "worthless", "useless"),
    ("scum", "trash", "garbage", "filth", "vermin", "disgusting"),
    ("despicable", "hateful", "subhuman", "retard", "retarded"),
    ("dumm", "dummkopf", "blöd", "trottel", "abschaum", "widerlich", "wertlos", "versager"),
    ("imbécile", "crétin", "débile", "ordure", "pourriture", "minable", "dégoûtant", "abruti"),
    ("idiota", "imbécil", "estúpido", "basura", "escoria", "inútil", "asqueroso", "patético"),
)
_WORD_TAG = np.uint64(0x51)


@dataclass
class Model:
    """Sorted feature hashes, their weights, and the bias; what the voters learnt, for reports."""

    features: np.ndarray
    weights: np.ndarray
    bias: float
    accuracies: np.ndarray
    groups: list[list[int]]


def word_hash(word: str) -> np.uint64:
    (part,) = hashing.slices(pa.array([word]))
    whole = hashing.Hashed(part, fold_latin=True)
    return hashing.mix(whole.runs(np.array([0]), np.array([len(part.data)])) ^ _WORD_TAG)[0]


def _features(part: hashing.Slice) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) for every word and word beginning, with repetitions."""
    hashed = hashing.Hashed(part, fold_latin=True)
    words = hashed.words(hashing.ALNUM)
    texts, found = [words.text], [hashing.mix(words.hash ^ _WORD_TAG)]
    for length in BEGINNINGS:
        long = np.flatnonzero(words.end - words.start > length)
        texts.append(words.text[long])
        found.append(hashed.runs(words.start[long], words.start[long] + length))
    return np.concatenate(texts), np.concatenate(found)


def _patterns(part: hashing.Slice) -> np.ndarray:
    """Votes of the pattern voters, a row per text: 1 toxic, 0 clean, -1 abstains."""
    ends = part.bounds
    total = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[ends])
    upper, lower = total((part.data >= 65) & (part.data <= 90)), total((part.data >= 97) & (part.data <= 122))
    shouts = total(part.data == 33)
    size = np.diff(ends)
    return np.stack(
        [
            np.where(upper > 4 * (lower + 5), 1, -1),
            np.where(shouts * 20 > size + 40, 1, -1),
            np.where(size < 20, 0, -1),
        ],
        axis=1,
    ).astype(np.int8)


_SAMPLE = "doc_id bigint, label int, features array<bigint>, patterns array<int>"


def _sample_features(sample: DataFrame) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in hashing.slices(batch.column(1)):
                n = len(part.bounds) - 1
                texts, found = _features(part)
                order = np.argsort(texts, kind="stable")
                ends = np.searchsorted(texts[order], np.arange(n + 1))
                found = found[order]
                lists = [np.unique(found[a:b]) for a, b in zip(ends, ends[1:], strict=False)]
                sizes = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
                yield pa.record_batch(
                    [
                        batch.column(0).slice(part.first, n),
                        batch.column(2).slice(part.first, n),
                        pa.ListArray.from_arrays(pa.array(sizes.astype(np.int32)), pa.array(np.concatenate(lists).view(np.int64))),
                        pa.array(_patterns(part).tolist(), pa.list_(pa.int32())),
                    ],
                    names=["doc_id", "label", "features", "patterns"],
                )

    return sample.select("doc_id", "text", "label").mapInArrow(giving_back(scan), _SAMPLE)


def label_model(votes: np.ndarray, anchors: int, rounds: int = 50) -> tuple[np.ndarray, np.ndarray, list[list[int]]]:
    """Posterior of class 1 per row, accuracy per voter, and groups of dependent voters.

    ``votes``: rows by voters, 1, 0 or -1 for abstention, which says nothing. A
    voter that votes has its own distribution in each class. Voters that go
    together within class 1 are found from the residuals; those of a group that
    vote on a row share one voice. The votes of the first ``anchors`` voters are
    where the estimation starts; no voter is right or wrong from then on.
    """
    n, v = votes.shape
    cast = np.stack([votes == 0, votes == 1]).astype(np.float64)
    posterior = np.where(cast[1][:, :anchors].any(axis=1), 0.9, 0.05)
    groups = [[j] for j in range(v)]
    for round_no in range(rounds):
        # How often a voter casts 0 and 1 in each class, with a weak prior that it is better than chance.
        rate = np.stack([
            (np.einsum("n,knv->kv", p, cast) + prior) / (p.sum() + 2)
            for p, prior in ((1 - posterior, [[0.02], [0.01]]), (posterior, [[0.01], [0.02]]))
        ])
        if round_no == 5:
            groups = _dependent(votes, posterior)
        share = min(max(posterior.mean(), 1e-3), 0.5)
        evidence = np.full(n, np.log(share / (1 - share)))
        for group in groups:
            said = np.einsum("knv,kv->n", cast[:, :, group], np.log(rate[1, :, group] / rate[0, :, group]).T)
            evidence += said / np.maximum(1, cast[:, :, group].sum(axis=(0, 2)))
        before, posterior = posterior, 1 / (1 + np.exp(-np.clip(evidence, -30, 30)))
        if np.abs(before - posterior).max(initial=0) < 1e-6 and round_no > 6:
            break
    right = posterior @ (votes == 1) + (1 - posterior) @ (votes == 0)
    accuracy = (right + 0.5) / ((votes != -1).sum(axis=0) + 1)
    return posterior, accuracy, groups


def _dependent(votes: np.ndarray, posterior: np.ndarray) -> list[list[int]]:
    """Groups of voters whose votes for class 1 go together beyond what the class explains."""
    v = votes.shape[1]
    fired = (votes == 1).astype(np.float64)
    p = np.where(posterior > 0.5, posterior, 0.0)
    linked = np.zeros((v, v), dtype=bool)
    if p.sum() >= 5:
        centred = fired - (p @ fired) / p.sum()
        cov = (centred * p[:, None]).T @ centred / p.sum()
        spread = np.sqrt(np.maximum(np.diag(cov), 1e-4))
        linked = cov / np.outer(spread, spread) > CORRELATED
    groups: list[list[int]] = []
    left = set(range(v))
    while left:
        stack, group = [left.pop()], []
        while stack:
            j = stack.pop()
            group.append(j)
            near = [i for i in left if linked[j, i]]
            left.difference_update(near)
            stack += near
        groups.append(sorted(group))
    return groups


def _fit_linear(has: np.ndarray, targets: np.ndarray) -> tuple[np.ndarray, float]:
    """Ridge logistic regression on soft targets by Newton steps."""
    x = np.hstack([has.astype(np.float64), np.ones((len(has), 1))])
    ridge = np.full(x.shape[1], RIDGE)
    ridge[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(ITERATIONS):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curvature = np.maximum(p * (1 - p), 1e-4)
        step = np.linalg.solve((x * curvature[:, None]).T @ x + np.diag(ridge), x.T @ (targets - p) - ridge * w)
        w += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-4:
            break
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, *, rows: int = TRAINING_ROWS, key: str = "doc_id", text: str = "text") -> Model:
    """Fit on at most ``rows`` labelled rows (``labels``: key, ``toxic``) that are not held out.

    Without such rows the seed words alone make the model.
    """
    seeds = [np.array(sorted({word_hash(w) for w in line}), dtype=np.uint64) for line in LEXICONS]
    all_seeds = np.unique(np.concatenate(seeds))
    sample = materialise(_sample_features(labelled_sample(docs, labels, F.col("toxic"), rows, key, text)), "toxicity-sample")
    n, toxic = sample.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    seed_model = Model(all_seeds, np.full(len(all_seeds), 3.0), -2.0, np.zeros(0), [])
    if not n or toxic in (0, n):
        return seed_model
    clean = n - toxic
    counts = (
        sample.select("label", F.explode("features").alias("feature"))
        .groupBy("feature")
        .agg(F.sum("label").alias("t"), F.count("*").alias("m"))
        .filter(F.col("m") >= MINED_LEAST)
    )
    t_share, c_share = F.col("t") / toxic, (F.col("m") - F.col("t")) / clean
    z = (t_share - c_share) / F.sqrt(F.col("m") / n * (1.0001 - F.col("m") / n) * (1 / toxic + 1 / clean))
    kept = counts.withColumn("z", z).filter(F.abs("z") > SIGNIFICANT).orderBy(F.desc(F.abs("z")), "feature").limit(FEATURES).collect()
    known = np.array([r["feature"] for r in kept], dtype=np.int64).view(np.uint64)
    mined = [
        i for i, r in enumerate(kept)
        if r["z"] > 0 and r["t"] >= max(MINED_LEAST, 0.005 * toxic) and r["t"] >= MINED_PRECISION * r["m"]
    ][:MINED_VOTERS]
    features = np.unique(np.concatenate([known, all_seeds]))
    wanted = F.broadcast(docs.sparkSession.createDataFrame([(int(x),) for x in features.view(np.int64)], "feature bigint"))
    # A row per sampled text: its screened features only.
    table = (
        sample.withColumn("row", F.monotonically_increasing_id())
        .select("row", "label", "patterns", F.explode_outer("features").alias("feature"))
        .join(wanted.withColumn("hit", F.lit(True)), "feature", "left")
        .groupBy("row")
        .agg(F.first("label").alias("label"), F.first("patterns").alias("patterns"), F.collect_list(F.when(F.col("hit"), F.col("feature"))).alias("features"))
        .orderBy("row")
        .toArrow()
    )
    lists = table.column("features").combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    row_of = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
    value = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    column = np.searchsorted(features, value)
    has = np.zeros((len(lists), len(features)), dtype=bool)
    has[row_of, column] = True
    voters = [has[:, np.searchsorted(features, known[i])] for i in mined]
    voters += [has[:, np.searchsorted(features, line)].any(axis=1) for line in seeds]
    votes = np.where(np.stack(voters, axis=1), 1, -1).astype(np.int8)
    quiet = np.where((votes == 1).any(axis=1), -1, 0).astype(np.int8)[:, None]
    patterns = np.array(table.column("patterns").to_pylist(), dtype=np.int8)
    posterior, accuracy, groups = label_model(np.hstack([votes, patterns, quiet]), len(mined) or len(voters))
    weights, bias = _fit_linear(has, posterior)
    used = weights != 0
    return Model(features[used], weights[used], bias, accuracy, groups)


def probabilities(texts: pa.Array, model: Model) -> np.ndarray:
    """Probability of class 1 of each text."""
    known, weights = model.features, model.weights
    maybe = np.zeros(1 << 16, dtype=bool)
    maybe[(known & np.uint64(0xFFFF)).astype(np.int64)] = True
    margin = np.full(len(texts), model.bias)
    for part in hashing.slices(texts):
        n = len(part.bounds) - 1
        owner, found = _features(part)
        likely = np.flatnonzero(maybe[(found & np.uint64(0xFFFF)).astype(np.int64)])
        owner, found = owner[likely], found[likely]
        if len(known):
            at = np.minimum(np.searchsorted(known, found), len(known) - 1)
            hit = known[at] == found
            once = np.unique(owner[hit] * len(known) + at[hit])
            margin[part.first : part.first + n] += np.bincount(once // len(known), weights=weights[once % len(known)], minlength=n)
    return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def score(docs: DataFrame, model: Model, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of whole texts, a row per row.

    A null or empty text has no features and the score of the bias; repeated
    rows have equal scores; a row without key is not held out. Key, language,
    source and labels are no part of a score; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = probabilities(batch.column(2), model)
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(value), pa.array((value >= 0.5).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    narrow = docs.select(F.col(key).cast("bigint").alias("doc_id"), held_out(key).alias("held_out"), F.col(text).alias("text"))
    return narrow.mapInArrow(giving_back(run), "doc_id bigint, held_out boolean, score double, predicted int")


def keep_clean(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``score`` does not predict toxic, with all their columns."""

    @arrow_udf("boolean")
    def clean(texts: pa.Array) -> pa.Array:
        return pa.array(probabilities(texts, model) < 0.5)

    return docs.filter(clean(F.col(text)))
