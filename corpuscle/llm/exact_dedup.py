"""Exact duplicates by a tree merge of sorted digest runs, with SQL functions only.

Every input partition gives one run: a row per digest of a text without
blanks, with the best document and the number of rows behind it. Runs are
numbered in base ``fan_in`` and exchanged in rounds, one per digit: in round j
a row moves to the run whose digit j is that of the row's digest, so ``fan_in``
runs meet, each sorted, and merge digest by digest. After the last round a
digest has one row, in the run that its hash names. A digest that a third of
all rows share meets at most ``fan_in`` rows in any merge of a round, after
the merge inside each task.

A digest alone is not trusted: texts are the same only if SHA-256, length and
a second hash agree, at every level.
"""

from __future__ import annotations

from math import ceil, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuscle.llm.skew import attach
from corpuscle.sources.shared import materialise

FAN_IN = 8
#: Fixed by the rule: texts are compared without the characters ``[\x20\x09-\x0D]``.
BLANKS = " \t\n\x0b\x0c\r"

SAME = ["digest", "length", "check"]


def without_blanks(text: Column) -> Column:
    for blank in BLANKS:
        text = F.replace(text, F.lit(blank), F.lit(""))
    return text


def hashed(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One narrow row per document: its id, what its text is compared by, and what ranks it."""
    whole = F.coalesce(F.col(text), F.lit(""))
    bare = without_blanks(whole)
    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.spark_partition_id().alias("run"),
        F.col(key).alias("doc_id"),
        F.unhex(F.sha2(bare, 256)).alias("digest"),
        F.length(bare).alias("length"),
        F.xxhash64(bare).alias("check"),
        F.length(whole).alias("n"),
        F.xxhash64(whole).alias("mark"),
    )


def merge_runs(rows: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """One row per text: ``digest, length, check``, the ``best`` row's rank, id and number, and ``size``.

    The longest original is best, then the smallest id (null after all
    others), then the smallest hash of the original text, then one of the
    rows that are equal in all of that.
    """
    runs = (rows.agg(F.max("run")).first()[0] or 0) + 1
    rounds = max(1, ceil(log(runs, fan_in) - 1e-9))
    best = F.struct(
        (-F.col("n")).alias("shorter"), F.col("doc_id").isNull().alias("unnamed"), "doc_id", "mark", "row"
    )
    merged = rows.select("run", *SAME, best.alias("best"), F.lit(1).cast("bigint").alias("size"))
    target = F.pmod(F.xxhash64("digest"), F.lit(fan_in**rounds)).cast("bigint")
    for at in range(rounds):
        low, high = fan_in**at, fan_in ** (at + 1)
        digit = lambda x: x % high - x % low  # noqa: B023, E731
        run = F.col("run").cast("bigint")
        moved = merged.withColumn("run", run - digit(run) + digit(target))
        merged = moved.groupBy("run", *SAME).agg(F.min("best").alias("best"), F.sum("size").alias("size"))
        merged = materialise(merged, "digest-runs")
    return merged.drop("run")


def find_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", fan_in: int = FAN_IN) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row of ``docs``.

    Texts are equal when they are without blanks; null counts as empty, and
    all empty texts are one group. Of a group exactly one row is kept (see
    ``merge_runs``), also if ids are repeated or null; ``keep_id`` is its id.
    Other columns are ignored, an empty table gives no rows. Texts are read
    once and never shuffled.
    """
    rows = materialise(hashed(docs, key, text), "digests")
    copies = materialise(merge_runs(rows, fan_in).filter("size > 1"), "copies")
    alone = F.col("size").isNull()
    return attach(rows, copies, SAME, "size").select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1).cast("bigint")).alias("group_size"),
        (alone | (F.col("row") == F.col("best.row"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with all columns; keys must be unique and not null."""
    dropped = materialise(find_copies(docs, key, text).filter("NOT kept").select(F.col("doc_id").alias("_dropped")), "dropped")
    return docs.join(dropped, F.col(key) == F.col("_dropped"), "left_anti")
