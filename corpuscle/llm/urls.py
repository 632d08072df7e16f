"""URL filter: rules first, then gradient-boosted trees on lexical features.

All of it is column expressions and Spark ML; no Python runs on the executors.
"""

from __future__ import annotations

from itertools import product
from typing import NamedTuple

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TREES = 20
DEPTH = 4
SEED = 11


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# The rules of the registered query.
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)

# Parts that the labelled URLs are made of: names of wanted sites are words, unwanted
# ones sell or track something, mostly with hyphens, digits or long parameters.
_GOOD_NAMES = ("library", "recipes", "garden", "physics", "museum", "weather", "travel", "history", "school", "journal", "review", "thread", "mountain", "river")
_BAD_NAMES = ("cheap-pills", "free-bets", "casino-win", "spam-farm", "ads-track", "best-loans24", "xxx-cams", "buy-followers", "win-prize-now", "click4cash", "hot-deals-777", "seo-links", "crack-keys", "replica-watch")
_SUFFIXES = ("com", "org", "net", "info", "biz", "top")
_GOOD_PATHS = ("/en/{n}", "/articles/{n}.html", "/blog/post-{n}/", "/de/{n}?page=2", "/a/b/{n}#top")
_BAD_PATHS = ("/en/{n}", "/go.php?id={n}&aff=88213&sub=x9&utm_source=feed", "/offer/{n}/?clickid=a8f3e9{n}77&c=1&k=2", "/{n}{n}{n}/win.html", "/r/{n}?u=aGVsbG8{n}")

FEATURES = (
    "url_length", "host_length", "host_labels", "host_hyphens", "host_digits", "longest_label",
    "path_length", "path_depth", "digit_ratio", "mark_ratio", "entropy", "host_entropy",
    "n_parameters", "query_length", "suffix_share", "suffix_bad",
)


def split_url(url: Column) -> tuple[Column, Column, Column]:
    """Host (A-Z lower-cased), path and query of a URL; a null or one without ``://`` has empty ones."""
    has = url.isNotNull() & url.contains("://")
    rest = F.regexp_replace(url, r"(?s)^.*?://", "")
    host = F.regexp_extract(rest, r"(?s)^[^/?#]*", 0)
    host = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(rest, r"(?s)^[^?#]*\?([^#]*)", 1)
    return F.when(has, host).otherwise(""), F.when(has, path).otherwise(""), F.when(has, query).otherwise("")


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null."""
    fits = None
    for rule in sorted(rules, key=lambda r: (-len(r.text), r.text)):
        hit = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        found = F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        fits = F.when(hit, found) if fits is None else fits.when(hit, found)
    return fits if fits is not None else F.lit(None).cast("struct<rule: string, verdict: string>")


def _entropy(text: Column) -> Column:
    """Bits per character of the characters' distribution."""
    characters = F.filter(F.split(text, ""), lambda c: c != "")
    n = F.size(characters)
    kinds = F.array_distinct(characters)
    bits = F.aggregate(
        kinds, F.lit(0.0),
        lambda total, kind: total - (n - F.size(F.array_remove(characters, kind))) / n * F.log2((n - F.size(F.array_remove(characters, kind))) / n),
    )
    return F.when(n > 0, bits).otherwise(0.0)


def lexical(df: DataFrame, url: str = "url") -> DataFrame:
    """Add ``host``, ``path`` and the lexical features, without the suffix statistics."""
    text = F.coalesce(F.col(url), F.lit(""))
    host, path, query = split_url(F.col(url))
    count = lambda c, pattern: F.length(F.regexp_replace(c, pattern, ""))
    size = F.greatest(F.length(text), F.lit(1))
    df = df.withColumns({"host": host, "path": path, "_query": query})
    host, path, query = F.col("host"), F.col("path"), F.col("_query")
    labels = F.split(host, r"\.")
    return df.withColumns(
        {
            "suffix": F.element_at(labels, -1),
            "url_length": F.length(text).cast("double"),
            "host_length": F.length(host).cast("double"),
            "host_labels": F.size(labels).cast("double"),
            "host_hyphens": count(host, "[^-]").cast("double"),
            "host_digits": count(host, "[^0-9]").cast("double"),
            "longest_label": F.array_max(F.transform(labels, F.length)).cast("double"),
            "path_length": F.length(path).cast("double"),
            "path_depth": F.size(F.filter(F.split(path, "/"), lambda s: s != "")).cast("double"),
            "digit_ratio": count(text, "[^0-9]") / size,
            "mark_ratio": count(text, r"[A-Za-z0-9/:.]") / size,
            "entropy": _entropy(text),
            "host_entropy": _entropy(host),
            "n_parameters": F.size(F.filter(F.split(query, "&"), lambda s: s != "")).cast("double"),
            "query_length": F.length(query).cast("double"),
        }
    ).drop("_query")


def labelled_urls(spark: SparkSession) -> DataFrame:
    """``url, bad``: a labelled table made by rule from the parts above, about 4,000 rows."""
    rows = []
    for bad, names, paths in ((0, _GOOD_NAMES, _GOOD_PATHS), (1, _BAD_NAMES, _BAD_PATHS)):
        for number, (name, suffix, path, prefix) in enumerate(product(names, _SUFFIXES, paths, ("", "www.", "m.", "blog."))):
            # The suffixes aren't equally trusted.
            if (suffix in ("com", "org", "net")) if not bad else True:
                rows.append((f"https://{prefix}{name}.example.{suffix}{path.format(n=number % 997)}", bad))
    return spark.createDataFrame(rows, "url string, bad int")


class UrlFilter(NamedTuple):
    model: GBTClassificationModel
    suffixes: tuple[tuple[str, float, float], ...]

    def features(self, df: DataFrame, url: str = "url") -> DataFrame:
        """Add all features: the suffix statistics are constants of the fit, one entry per labelled suffix."""
        df = lexical(df, url)
        entries = [x for s, share, bad in self.suffixes for x in (F.lit(s), F.struct(F.lit(share).alias("share"), F.lit(bad).alias("bad")))]
        table = F.create_map(*entries)
        known = F.coalesce(F.try_element_at(table, F.col("suffix")), F.struct(F.lit(0.0).alias("share"), F.lit(0.5).alias("bad")))
        return df.withColumns({"suffix_share": known["share"], "suffix_bad": known["bad"]})


def _assembled(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="_features").transform(df)


def fit(labelled: DataFrame, *, url: str = "url", bad: str = "bad", trees: int = TREES, depth: int = DEPTH, most_suffixes: int = 1000) -> UrlFilter:
    """Train on labelled URLs; rows without url or label are left out.

    The statistics of at most ``most_suffixes`` suffixes are kept, the most
    frequent; others count as unseen.
    """
    labelled = labelled.select(F.col(url).alias("url"), F.col(bad).cast("double").alias("bad")).dropna()
    rows = (
        lexical(labelled).groupBy("suffix")
        .agg(F.count("*").alias("n"), F.sum("bad").alias("m"))
        .orderBy(F.desc("n"), "suffix").limit(most_suffixes).collect()
    )
    total = sum(r["n"] for r in rows)
    suffixes = tuple((r["suffix"], r["n"] / total, (r["m"] + 1.0) / (r["n"] + 2.0)) for r in rows)
    untrained = UrlFilter(None, suffixes)
    training = _assembled(untrained.features(labelled)).select("_features", "bad")
    trainer = GBTClassifier(featuresCol="_features", labelCol="bad", maxIter=trees, maxDepth=depth, seed=SEED)
    return UrlFilter(trainer.fit(training), suffixes)


def judge(pages: DataFrame, filter_: UrlFilter, *, rules: tuple[Rule, ...] = RULES, key: str = "page_id", url: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict, bad_score``, a row per row of ``pages``.

    The longest fitting rule decides, else the trees: block from a score of 0.5.
    A null url, or one without ``://``, has empty host and path and no rule and
    is judged by its features like any other; repeated rows and null keys are
    rows of their own; other columns are ignored.
    """
    narrow = pages.select(F.col(key).cast("bigint").alias("page_id"), F.col(url).alias("url"))
    scored = filter_.model.transform(_assembled(filter_.features(narrow)))
    score = vector_to_array(F.col("probability"))[1]
    rule = rule_of(F.col("host"), F.col("path"), rules)
    return scored.select("page_id", "host", "path", rule.alias("_rule"), score.alias("bad_score")).select(
        "page_id", "host", "path",
        F.col("_rule.rule").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), F.when(F.col("bad_score") >= 0.5, "block").otherwise("allow")).alias("verdict"),
        "bad_score",
    )
