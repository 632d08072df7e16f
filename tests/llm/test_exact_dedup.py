"""Exact duplicates against a dictionary of normalised texts."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest

from corpuscle.llm import exact_dedup
from corpuscle.llm.skew import attach


def _expected(rows):
    groups = defaultdict(list)
    for key, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((key, text or ""))
    out = []
    for bare, members in groups.items():
        sha = hashlib.sha256(bare.encode()).hexdigest()
        order = sorted(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))
        out += [(m[0], order[0][0], len(members), place == 0, sha) for place, m in enumerate(order)]
    return sorted(out, key=repr)


def _frame(spark, rows):
    return spark.createDataFrame([(k, t, 1, 2, 3) for k, t in rows], "doc_id bigint, text string, size int, row int, run int")


def _got(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize(("parts", "fan_in"), [(1, 8), (7, 2), (20, 3)])
def test_against_groups(spark, parts, fan_in):
    rng = np.random.default_rng(parts)
    words = ["a", "bé", "\n", " ", "\t", "😀", "\x0b", "\xa0"]
    rows = [(i, "".join(rng.choice(words, rng.integers(0, 5)))) for i in range(600)]
    rows += [(600 + i, "the same" + " " * int(rng.integers(0, 4))) for i in range(400)]
    rows += [(2000, "long " * 200_000), (2001, "long" * 200_000)]
    df = _frame(spark, rows).repartition(parts)
    assert _got(exact_dedup.find_copies(df, fan_in=fan_in)) == _expected(rows)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (None, "x y"), (None, "xy"), (5, "xy"), (5, "xy"), (6, "a"), (6, "a"), (7, "a\xa0"), (8, "x\x00y"), (None, "q"), (None, "q")]
    assert _got(exact_dedup.find_copies(_frame(spark, rows))) == _expected(rows)
    assert exact_dedup.find_copies(_frame(spark, [])).collect() == []


def test_drop_copies_keeps_columns(spark):
    rows = [(1, "a b"), (2, "ab"), (3, "c"), (4, "a  b")]
    kept = exact_dedup.drop_copies(_frame(spark, rows))
    assert kept.columns == ["doc_id", "text", "size", "row", "run"]
    assert sorted(r[0] for r in kept.collect()) == [3, 4]


def test_main_path_has_no_python(spark):
    plan = exact_dedup.find_copies(_frame(spark, [(1, "a")]))._jdf.queryExecution().toString()
    assert not any(name in plan for name in ("InArrow", "InPandas", "PythonUDF", "EvalPython"))


@pytest.mark.parametrize("hot_rows", [2, 1000])
def test_attach(spark, hot_rows):
    rows = spark.createDataFrame([(i, None if i % 3 == 0 else i % 7) for i in range(60)], "i int, k int")
    groups = rows.groupBy("k").count().filter("k IS NULL OR k > 2")
    got = attach(rows, groups, ["k"], "count", hot_keys=3, hot_rows=hot_rows)
    sizes = {r["k"]: r["count"] for r in groups.collect()}
    assert sorted(map(tuple, got.collect())) == sorted((i, k, sizes.get(k)) for i, k in map(tuple, rows.collect()))
