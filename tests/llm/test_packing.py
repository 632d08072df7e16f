"""Packing against plain statements: every id once, gapless, close to the lower bound."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from corpuscle.llm import packing


def _check_plan(counts, capacity, **options):
    runs = packing.plan(counts, capacity, **options)
    seen = Counter()
    for length, rank, n, _, _ in packing.intervals(runs):
        seen.update((length, rank + i) for i in range(n))
    assert seen == Counter((length, i) for length, n in counts.items() for i in range(n))
    for run in runs:
        assert run.n > 0 and sum(x for x, _ in run.held) == capacity - run.room >= 1
    return sum(run.n for run in runs)


def _best_fit_decreasing(counts, capacity):
    """Sequences that plain best fit, longest piece first, makes."""
    with_room = [0] * (capacity + 1)
    used = 0
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            room = next((r for r in range(length, capacity + 1) if with_room[r]), None)
            if room is None:
                used, room = used + 1, capacity
            else:
                with_room[room] -= 1
            with_room[room - length] += 1
    return used


def _histogram(seed):
    rng = random.Random(seed)
    n = rng.choice([1, 30, 2000, 8000])
    if seed % 2:
        return dict(Counter(rng.randint(rng.choice([1, 60]), 256) for _ in range(n)))
    mu = rng.choice([2, 4])
    return dict(Counter(min(256, max(1, int(rng.lognormvariate(mu, 1)))) for _ in range(n)))


@pytest.mark.parametrize("seed", range(12))
def test_plan_places_all_pieces_once(seed):
    counts = _histogram(seed)
    plain = _best_fit_decreasing(counts, 256)
    assert _check_plan(counts, 256) <= plain
    for groups in (1, 5, 64):
        assert _check_plan(counts, 256, groups=groups) <= plain * 1.02 + 2


def test_configurations_hold_most_of_what_fits_exactly():
    counts = {100: 500, 156: 500, 60: 300, 136: 150, 3: 7}
    runs = packing.plan(counts, 256)
    assert sum(run.n for run in runs if not run.room) == 650
    assert sum(run.n for run in runs) == _best_fit_decreasing(counts, 256) == packing.lower_bound(counts, 256)


def test_plan_edges():
    assert packing.plan({}, 16) == []
    assert _check_plan({16: 3}, 16) == 3
    assert _check_plan({9: 4}, 16) == 4
    assert _check_plan({8: 5}, 16) == 3
    assert _check_plan({1: 33}, 16) == 3
    with pytest.raises(ValueError):
        packing.plan({17: 1}, 16)


def _expected_pieces(rows, capacity):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = []
    for doc, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = np.asarray(ids[at : at + capacity], dtype="<u4").tobytes()
            out.append((doc, piece, at, len(part) // 4, zlib.crc32(part)))
    return out


def test_pack_against_whole_texts(spark):
    rng = random.Random(5)
    words = ["a", "Don't", "é́́", "µm", "Ǆx,", "ª.", "DON.%%", "it's,", "naïve", "  ", " x", "12 345", "<|endoftext|>", "…!?", "ΣΑΣ", "\x1c", "猫が好き", "\n\n", "y" * 70, "we'LL"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 5, 60, 400])))) for i in range(60)]
    rows += [(100, None), (101, ""), (3, rows[3][1]), (None, "no key"), (102, "word " * 9000)]
    docs = spark.createDataFrame(
        [(a, b, 1, 2, 3, 4) for a, b in rows],
        "doc_id bigint, text string, length int, piece int, sequence_id int, offset int",
    )
    got = packing.pack(docs, capacity=128).collect()
    assert Counter(tuple(r[:5]) for r in got) == Counter(_expected_pieces(rows, 128))
    inside = defaultdict(list)
    for r in got:
        inside[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in inside.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 128
    lengths = Counter(r["length"] for r in got)
    assert packing.lower_bound(lengths, 128) <= len(inside) <= _best_fit_decreasing(lengths, 128)


def test_empty_table(spark):
    got = packing.pack(spark.createDataFrame([], "doc_id bigint, text string"))
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert got.count() == 0


def test_common_words_stay_remembered(monkeypatch):
    """op10: a full memory drops the words that weren't met lately, not the common ones."""
    monkeypatch.setattr(packing, "REMEMBERED", 8)
    encoder, asked = packing._kept_encoder(None), []
    assert packing._kept_encoder(None) is encoder
    encode = packing._Words.encode
    monkeypatch.setattr(packing._Words, "encode", lambda words, word: asked.append(word) or encode(words, word))
    for i in range(20):
        text = f"commonly Commonly, été{i} x{i} y{i}"
        expected = encoder.words.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder(text), dtype="<u4").tolist() == expected
    assert asked.count("commonly") == 1
