"""Licence scan by diagonal voting.

Every rolling word k-gram of a document that also stands in a template is a
vote for a diagonal: the place where the template would have to begin. Votes are
joined to template positions, summed by (document, template, diagonal),
neighbouring diagonals of a long template are merged, so that inserted or
missing words do no harm, and the spans are verified by the share of the
template's grams they hold.

The k-grams are hashed in Arrow batches, where grams of no template are left
out (a semi-join with the fixed set of template grams); the join, the votes and
the merging are DataFrame work on what remains.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpuscle.llm import hashing
from corpuscle.sources.shared import materialise

PHRASE_K = 2
TEXT_K = 5
# Diagonals of a text at most this far apart belong together.
MERGE_GAP = 12
# Share of a text's grams, and length of the span against the text's, from which a span counts.
TEXT_SHARE = 0.5
SPAN_RATIO = (0.5, 1.6)

# The phrases that count as base labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Names of licences as they are written.
PHRASES = {
    "apache license version 2 0": "apache-2.0",
    "gnu general public license version 2": "gpl-2.0",
    "gnu general public license version 3": "gpl-3.0",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "isc license": "isc",
    "cc by nc": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
}

# Notices as their licences word them.
TEXTS = {
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including
        without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
        copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
        following conditions: The above copyright notice and this permission notice shall be included in all
        copies or substantial portions of the Software.""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee
        is hereby granted, provided that the above copyright notice and this permission notice appear in all
        copies.""",
    "bsd": """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: Redistributions of source code must retain the above
        copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form
        must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
        documentation and/or other materials provided with the distribution.""",
    "apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file
        except in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,
        software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
        CONDITIONS OF ANY KIND, either express or implied.""",
    "gpl": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation, either version 3 of the License, or
        (at your option) any later version. This program is distributed in the hope that it will be useful, but
        WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR
        PURPOSE.""",
}


class Template(NamedTuple):
    text: str
    label: str
    base: bool
    k: int
    gap: int
    share: float


def default_templates() -> list[Template]:
    return [
        *(Template(text, label, True, PHRASE_K, 0, 1.0) for text, label in BASE_PHRASES.items()),
        *(Template(text, label, False, PHRASE_K, 0, 1.0) for text, label in PHRASES.items()),
        *(Template(text, label, False, TEXT_K, MERGE_GAP, TEXT_SHARE) for label, text in TEXTS.items()),
    ]


def template_positions(spark: SparkSession, templates: list[Template]) -> DataFrame:
    """Every gram of every template with its position; as large as the templates."""
    rows = []
    for number, t in enumerate(templates):
        words = hashing.text_words(t.text, hashing.ALNUM)
        at, gram = hashing.grams(words, t.k)
        if not len(at):
            raise ValueError(f"a template has at least {t.k} words: {t.text!r}")
        signed = gram.view(np.int64)
        rows += [
            (number, t.label, t.base, t.k, t.gap, float(t.share), len(words.hash), len(at), int(p), int(g))
            for p, g in zip(at, signed, strict=True)
        ]
    return spark.createDataFrame(
        rows,
        "template int, label string, base boolean, k int, gap int, share double, n_words int, n_grams int, place int, gram bigint",
    )


_FOUND = "row_id bigint, doc_id bigint, n_words bigint, hits array<struct<at: bigint, gram: bigint>>"
_HIT = pa.struct([("at", pa.int64()), ("gram", pa.int64())])
_FOUND_ARROW = pa.schema([("row_id", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("hits", pa.list_(_HIT))])


def document_grams(docs: DataFrame, templates: list[Template], key: str, text: str) -> DataFrame:
    """Per document its number of words and the places of grams that a template has."""
    wanted: dict[int, set[int]] = {}
    for t in templates:
        _, gram = hashing.grams(hashing.text_words(t.text, hashing.ALNUM), t.k)
        wanted.setdefault(t.k, set()).update(gram.tolist())
    sorted_grams = {k: np.array(sorted(v), dtype=np.uint64) for k, v in wanted.items()}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maybe = {}
        for k, known in sorted_grams.items():
            maybe[k] = np.zeros(1 << 16, dtype=bool)
            maybe[k][(known & np.uint64(0xFFFF)).astype(np.int64)] = True
        for batch in batches:
            for part in hashing.slices(batch.column(2)):
                n = len(part.bounds) - 1
                words = hashing.Hashed(part).words(hashing.ALNUM)
                n_words = np.bincount(words.text, minlength=n)
                first_word = np.cumsum(n_words) - n_words
                texts, places, found = [], [], []
                for k, known in sorted_grams.items():
                    at, gram = hashing.grams(words, k)
                    likely = maybe[k][(gram & np.uint64(0xFFFF)).astype(np.int64)]
                    at, gram = at[likely], gram[likely]
                    hit = known[np.minimum(np.searchsorted(known, gram), len(known) - 1)] == gram
                    texts.append(words.text[at[hit]])
                    places.append(at[hit] - first_word[texts[-1]])
                    found.append(gram[hit].view(np.int64))
                text_no = np.concatenate(texts)
                order = np.argsort(text_no, kind="stable")
                hits = pa.StructArray.from_arrays(
                    [pa.array(np.concatenate(places)[order]), pa.array(np.concatenate(found)[order])], fields=list(_HIT)
                )
                ends = np.concatenate([[0], np.cumsum(np.bincount(text_no, minlength=n))]).astype(np.int32)
                yield pa.record_batch(
                    [
                        batch.column(0).slice(part.first, n),
                        batch.column(1).slice(part.first, n),
                        pa.array(n_words.astype(np.int64)),
                        pa.ListArray.from_arrays(pa.array(ends), hits),
                    ],
                    schema=_FOUND_ARROW,
                )

    narrow = docs.select(
        F.monotonically_increasing_id().alias("row_id"), F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text")
    )
    return narrow.mapInArrow(scan, _FOUND)


def spans(found: DataFrame, templates: list[Template]) -> DataFrame:
    """Spans that may hold a template: ``row_id, template, label, base, start, end, coverage, verified``."""
    positions = F.broadcast(template_positions(found.sparkSession, templates))
    votes = (
        found.select("row_id", F.explode("hits").alias("hit"))
        .select("row_id", "hit.at", "hit.gram")
        .join(positions, "gram")
        .groupBy("row_id", "template", "label", "base", "k", "gap", "share", "n_words", "n_grams", (F.col("at") - F.col("place")).alias("diagonal"))
        .agg(F.count("*").alias("votes"), F.min("at").alias("first"), F.max(F.col("at") + F.col("k")).alias("end"))
    )
    along = Window.partitionBy("row_id", "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(along) > F.col("gap")
    merged = (
        votes.withColumn("new", F.coalesce(apart.cast("int"), F.lit(1)))
        .withColumn("cluster", F.sum("new").over(along))
        .groupBy("row_id", "template", "label", "base", "gap", "share", "n_words", "n_grams", "cluster")
        .agg(F.sum("votes").alias("votes"), F.min("first").alias("start"), F.max("end").alias("end"))
    )
    coverage = F.least(F.lit(1.0), F.col("votes") / F.col("n_grams"))
    ratio = (F.col("end") - F.col("start")) / F.col("n_words")
    verified = (coverage >= F.col("share")) & ((F.col("gap") == 0) | ratio.between(*SPAN_RATIO))
    return merged.select("row_id", "template", "label", "base", "start", "end", coverage.alias("coverage"), verified.alias("verified"))


def scan(docs: DataFrame, *, templates: list[Template] | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Labels of whole texts, a row per row of ``docs``.

    ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score``: number and outer starts of the base phrases' places, labels of the
    base phrases and of all verified spans, and the largest share of a template
    found. A null or empty text has no words, no labels and score 0; repeated
    rows and null ids are rows of their own; other columns are ignored.
    """
    templates = default_templates() if templates is None else templates
    found = materialise(document_grams(docs, templates, key, text), "license-grams")
    is_base = F.col("base") & F.col("verified")
    joined = lambda c: F.concat_ws(",", F.array_sort(F.collect_set(c)))
    per_row = (
        spans(found, templates)
        .groupBy("row_id")
        .agg(
            F.count_if(is_base).alias("n_base"),
            F.min(F.when(is_base, F.col("start"))).alias("first_word"),
            F.max(F.when(is_base, F.col("start"))).alias("last_word"),
            joined(F.when(is_base, F.col("label"))).alias("base_labels"),
            joined(F.when(F.col("verified"), F.col("label"))).alias("labels"),
            F.max("coverage").alias("score"),
        )
    )
    return found.select("row_id", "doc_id", "n_words").join(per_row, "row_id", "left").select(
        "doc_id", "n_words",
        F.coalesce("n_base", F.lit(0)).cast("bigint").alias("n_base"),
        F.col("first_word").cast("bigint"), F.col("last_word").cast("bigint"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
