"""Repairs against all sequences of edits, by a plain search over strings."""

import hashlib
import re
import zlib
from collections import defaultdict
from functools import lru_cache
from pathlib import Path

import numpy as np
import pytest

from corpuscle.llm import conversations as cv

NEXT = {"": "su", "s": "u", "u": "a", "a": "u"}


def _damaged(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        out[conv] += []
        shown = [" " if x is None else x for x in (conv, turn, role, text)]
        fault = zlib.crc32(f"{shown[0]}:{shown[1]}".encode()) % 20
        role, text = shown[2:]
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        out[conv] += [] if fault == 0 else [(turn, role, text)] * (2 if fault == 3 else 1)
    return out


def _expected_one(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
    faults, seen = [], set()
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))

    @lru_cache(None)
    def best(i, last, inserted):
        """(cost, letters, repaired rows) from row i on, after initial ``last``."""
        found = []
        if i == len(rows):
            if last in ("", "a"):
                found.append((0, "", ()))
        else:
            _, role, text = rows[i]
            bad = faults[i] in ("blank", "duplicate")
            more = 5 if faults[i] == "truncated" else 0
            cost, letters, kept = best(i + 1, last, 0)
            found.append((2 + cost, "D" + letters, kept))
            if not bad and role[:1] and role[0] in NEXT[last]:
                cost, letters, kept = best(i + 1, role[0], 0)
                found.append((more + cost, "K" + letters, (f"{role}:{text}", *kept)))
            for new in ("user", "assistant") if not bad else ():
                if new[0] in NEXT[last]:
                    cost, letters, kept = best(i + 1, new[0], 0)
                    found.append((1 + more + cost, "R" + letters, (f"{new}:{text}", *kept)))
        for new in ("user", "assistant") if inserted < 3 else ():
            if new[0] in NEXT[last]:
                cost, letters, kept = best(i, new[0], inserted + 1)
                found.append((5 + cost, "I" + letters, (f"{new}:", *kept)))
        return min(found, default=(10**6, "", ()))

    cost, audit, kept = best(0, "", 0)
    turns = {t for t, *_ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    initials = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    sha = hashlib.sha256("\n".join(kept).encode()).hexdigest()
    return (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, sha)


def _expected(rows):
    return sorted(((c, *_expected_one(r)) for c, r in _damaged(rows).items()), key=repr)


def _frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "conv_id bigint, turn bigint, role string, text string, place int, row int, at int")


def _got(spark, rows, **options):
    df = _frame(spark, rows).repartition(3)
    out = cv.repair(cv.damage(df), df, **options)
    assert out.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted(map(tuple, out.collect()), key=repr)


def _rows(seed, convs, longest):
    rng = np.random.default_rng(seed)
    roles = ["system", "user", "user", "assistant", "assistant", "tool", None, "", "u", "User"]
    texts = ["Yes.", "No!", "Cut", "", " \n", "Why? ", "é", None, "a.b", "x?\xa0"]
    rows = []
    for conv in range(convs):
        for turn in range(int(rng.integers(1, longest))):
            shown = None if rng.random() < 0.05 else turn + int(rng.integers(0, 3))
            rows.append((None if conv == 0 else conv, shown, roles[rng.integers(len(roles))], texts[rng.integers(len(texts))]))
    return rows


@pytest.mark.parametrize(("long", "segment"), [(10_000, 100), (3, 4), (0, 1), (9, 5)])
def test_against_all_edits(spark, long, segment):
    rows = _rows(long, 60, 14)
    assert _got(spark, rows, long=long, segment=segment, hot_keys=1000) == _expected(rows)


def test_one_conversation_holds_a_third(spark):
    rows = _rows(5, 30, 8) + [(7, i // 2, ["user", "assistant"][i % 2], f"Line {i % 50}.") for i in range(400)]
    assert _got(spark, rows, long=50, segment=64) == _expected(rows)


def test_empty_and_dropped(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows = [(gone, 0, "user", "Hello.")]
    assert _got(spark, rows) == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]
    assert _got(spark, []) == []


def test_very_long_text(spark):
    rows = [(1, 1, "user", "word " * 400_000 + "."), (1, 2, "assistant", "x" * 1_000_000)]
    assert _got(spark, rows) == _expected(rows)


def test_tables_agree_with_single_rows():
    t = cv.tables()
    assert len(t.vectors) < 200
    rng = np.random.default_rng(0)
    for n in range(0, 40, 3):
        signs = rng.integers(0, cv.SYMBOLS, n)
        after = np.arange(len(t.vectors))
        before, more = cv.pass_back(signs, after)
        costs = np.zeros(len(after), dtype=int)
        for sign in signs[::-1]:
            costs += t.more[after, sign]
            after = t.before[after, sign]
        assert (before == after).all() and (more == costs).all()


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="test tables are not here")
def test_query(spark):
    from corpuscle.llm.queries import queries

    table = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    got = queries()["op12_block_table_repair"](spark, "/root/testdata/sf0.001")
    assert sorted(map(tuple, got.collect()), key=repr) == _expected(rows)
