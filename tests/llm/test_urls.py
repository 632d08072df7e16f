"""URL filter: rules against a plain statement, trees against held-out URLs."""

import random
import re

import pytest

from corpuscle.llm import urls


def _expected(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), re.split("[/?#]", rest)[0])
    path = re.split("[?#]", rest[len(host) :])[0]
    fits = [r for r in urls.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    return host, path, best and best.text, best and best.verdict


URLS = [
    None, "", "no scheme.com/en/", "http://", "http://com/", "http://COM/x", "http://example.com/en/1", "http://www.example.com/en/2",
    "http://a.www.EXAMPLE.com/en/", "http://wwwexample.com/en/", "http://x.net/es/1?b=/fr/", "http://x.net/fr", "http://net/fr/", "https://ünï.net/es/ä#x",
    "http://a?b://c.com/", "http://a.com", "ftp://a://b.com/", "http://spam-farm.example.org/x", "http://library.example.org/en/2", "x\n://y.com/\nz", "http://u@b.com:80/p",
]


@pytest.fixture(scope="module")
def trained(spark):
    return urls.fit(urls.labelled_urls(spark))


def test_rules(spark, trained):
    rows = [(i, u, "clash", 1.0) for i, u in enumerate([*URLS, "http://x.com/" + "a/" * 20_000])] + [(None, URLS[6], "h", 1.0), (0, None, "h", 1.0)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host string, entropy double")
    got = urls.judge(pages, trained).collect()
    key = lambda r: tuple(map(repr, r))
    expected = sorted(((i, *_expected(u)[:3]) for i, u, _, _ in rows), key=key)
    assert sorted(((r["page_id"], r["host"], r["path"], r["rule"]) for r in got), key=key) == expected
    by_url = {i: _expected(u)[3] for i, u, _, _ in rows}
    for r in got:
        assert r["verdict"] in ("allow", "block") and r["verdict"] == (by_url[r["page_id"]] or r["verdict"])
    assert got[17]["verdict"] == "block" and got[18]["verdict"] == "allow"
    assert urls.judge(pages.limit(0), trained).count() == 0


def test_held_out_urls(spark, trained):
    rng = random.Random(8)
    names = [("".join(rng.choices(["the", "ra", "ion", "ble", "sh", "er"], k=3)), 0) for _ in range(100)]
    names += [(f"{rng.choice(['mega', 'free', 'hot'])}-{rng.choice(['slots', 'meds', 'promo'])}{rng.choice(['', '24'])}", 1) for _ in range(100)]
    rows = [(i, f"http://{rng.choice(['', 'www.', 'blog.'])}{n}.example.org/{rng.choice(['en', 'de'])}/{rng.randrange(1000)}{rng.choice(['', '?page=2&ref=x', '/', '#top'])}", y) for i, (n, y) in enumerate(names)]
    got = urls.judge(spark.createDataFrame(rows, "page_id bigint, url string, bad int"), trained).collect()
    right = sum((r["verdict"] == "block") == bool(rows[r["page_id"]][2]) for r in got)
    assert right >= 0.95 * len(rows)


def test_no_python_on_executors(spark, trained):
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id bigint, url string")
    assert "Python" not in urls.judge(pages, trained)._jdf.queryExecution().executedPlan().toString()
