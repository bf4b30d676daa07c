"""License scans by diagonal voting.

Word k-gram hashes of every text meet the k-grams of license templates in one join. A hit of
document position p and template position t votes for the diagonal p - t. Votes are aggregated by
document, template and diagonal; neighbouring diagonals are merged, as a word put in or left out
moves the rest of a passage to the next one; and what has votes enough is verified word by word.

* A template of fewer than `FUZZY_WORDS` words is a phrase: it counts where all its words stand
  consecutively, that is where one diagonal has all of its 2-grams.
* A longer one is a passage: the template is aligned with the words around the diagonals, and
  counts if at most one word in five is put in, left out or replaced. With e such edits at most
  3e of its 3-grams are lost, so diagonals within e of each other that share fewer than
  n - 2 - 3e of them need no check, and no passage that passes the check is missed.

A document's diagonals are verified in ranges of `RANGE`. A vote also goes to other ranges if a
place there may depend on it, and a range returns the places on its own diagonals: what one call
gets is bounded, however many passages a document repeats.

The words compared travel with the hit, so texts are not shuffled. Templates are a fixed table
of this module, hence the broadcast.

Defined cases: a null text counts as empty and has no words, labels "" and score 0; rows with
the same doc_id and text are scanned as one and returned each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.words import (
    IS_ALNUM,
    LOWER,
    Block,
    blocks,
    first_words,
    gram_hashes,
    span_hashes,
    spans,
)

FUZZY_WORDS = 8
# Diagonals of a document that are verified together.
RANGE = 4096
PHRASE_GRAM, PASSAGE_GRAM = 2, 3


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    base: bool = False


# The base phrases.
BASE = (
    Template("gpl", "gnu general public license", True),
    Template("apache", "apache license", True),
    Template("cc-by", "cc by", True),
    Template("mit", "mit license", True),
)
# Public wording of common licenses, their notices and short names.
OWN = (
    Template("cc-by-nc", "cc by nc"),
    Template("cc-by-sa", "cc by sa"),
    Template("cc-by-nd", "cc by nd"),
    Template("cc0", "cc0 1 0"),
    Template("cc-by", "creative commons attribution"),
    Template("apache-2.0", "apache license version 2 0"),
    Template("gpl-3.0", "gnu general public license version 3"),
    Template("gpl-2.0", "gnu general public license version 2"),
    Template("lgpl", "gnu lesser general public license"),
    Template("agpl", "gnu affero general public license"),
    Template("mpl", "mozilla public license"),
    Template("bsd", "bsd license"),
    Template("all-rights-reserved", "all rights reserved"),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files to deal in the software without restriction",
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met",
    ),
    Template(
        "apache-2.0",
        "you may not use this file except in compliance with the license you may obtain a copy "
        "of the license at http www apache org licenses license 2 0",
    ),
    Template(
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms "
        "of the gnu general public license as published by the free software foundation",
    ),
    Template(
        "mpl",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or "
        "without fee is hereby granted",
    ),
    Template(
        "unlicense",
        "this is free and unencumbered software released into the public domain",
    ),
)
TEMPLATES = BASE + OWN


def edits_allowed(n_words: int) -> int:
    return n_words // 5 if n_words >= FUZZY_WORDS else 0


def gram_of(n_words: int) -> int:
    return PASSAGE_GRAM if n_words >= FUZZY_WORDS else PHRASE_GRAM


def _words_of(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the block, and each row's first word."""
    lower = LOWER[block.data]
    starts, ends = spans(block, IS_ALNUM[lower])
    return span_hashes(lower, starts, ends), first_words(block.row_of(starts), block.rows)


def word_hashes(text: str) -> np.ndarray:
    """Hashes of the words of one text."""
    hashes = [_words_of(b)[0] for b in blocks(pa.array([text], pa.large_string()))]
    return np.concatenate(hashes)


def _template_grams(spark: SparkSession, templates: tuple[Template, ...]) -> DataFrame:
    """(gram, template, t, n, slack, reach): every gram of every template."""
    rows = []
    for number, template in enumerate(templates):
        hashes = word_hashes(template.text)
        n, k = len(hashes), gram_of(len(hashes))
        for t, gram in enumerate(gram_hashes(hashes, k).view(np.int64).tolist()):
            rows.append((gram, number, t, n, edits_allowed(n), reach(n)))
    return spark.createDataFrame(rows, "gram long, template int, t int, n int, slack int, reach int")


def _grams(docs: DataFrame) -> DataFrame:
    """(doc_id, row_key, words, n_pairs, grams): word hashes of every text, and the hashes of its
    `n_pairs` 2-grams followed by those of its 3-grams."""
    source = docs.select("doc_id", F.xxhash64("text").alias("row_key"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def lists(values: list[np.ndarray]) -> pa.Array:
        ends = np.cumsum([0, *map(len, values)])
        flat = np.concatenate(values) if values else np.zeros(0, np.uint64)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view(np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(2)):
                hashes, firsts = _words_of(block)
                pairs, triples = gram_hashes(hashes, PHRASE_GRAM), gram_hashes(hashes, PASSAGE_GRAM)
                words, grams, n_pairs = [], [], []
                for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist()):
                    own = pairs[a : max(b - PHRASE_GRAM + 1, a)]
                    words.append(hashes[a:b])
                    n_pairs.append(len(own))
                    grams.append(np.concatenate([own, triples[a : max(b - PASSAGE_GRAM + 1, a)]]))
                rows = slice(block.first, block.first + block.rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[rows], batch.column(1)[rows], lists(words), pa.array(n_pairs, pa.int32()), lists(grams)],
                    names=["doc_id", "row_key", "words", "n_pairs", "grams"],
                )

    return source.mapInArrow(
        run, f"doc_id {kind}, row_key long, words array<long>, n_pairs int, grams array<long>"
    )


def align(template: list[int], words: list[int]) -> tuple[int, int, int]:
    """(edits, first, end): the fewest words put in, left out or replaced that turn the template
    into some run of `words`, and that run (the earliest end)."""
    cost, begin = [0] * (len(words) + 1), list(range(len(words) + 1))
    for i, t in enumerate(template, 1):
        last_cost, last_begin = cost, begin
        cost, begin = [i], [0]
        for j, w in enumerate(words, 1):
            options = (
                (last_cost[j - 1] + (t != w), last_begin[j - 1]),
                (last_cost[j] + 1, last_begin[j]),
                (cost[j - 1] + 1, begin[j - 1]),
            )
            best = min(options, key=lambda o: o[0])
            cost.append(best[0])
            begin.append(best[1])
    end = min(range(len(cost)), key=cost.__getitem__)
    return cost[end], begin[end], end


def _whole(hits: list[int], n_grams: int, vote: dict, template: list[int]) -> bool:
    """Whether the template stands word by word on the vote's own diagonal."""
    at = vote["diagonal"] - vote["first"]
    return len(hits) == n_grams and list(vote["window"][at : at + len(template)]) == template


def verified_places(votes: list[dict], template: list[int]) -> list[tuple[int, int, int, float]]:
    """(diagonal, first word, end, similarity) of the template's places, from diagonals of one
    document: dicts of `diagonal`, `hits` (template positions), `first` and `window` (words from
    `first`). Of places that overlap, one is left out if another is more similar, or as similar
    and earlier. Linear in the votes: what a place depends on lies within `reach` diagonals."""
    n = len(template)
    slack, n_grams = edits_allowed(n), n - gram_of(n) + 1
    votes = sorted(votes, key=lambda v: v["diagonal"])
    hits = [set(v["hits"]) for v in votes]
    if not slack:
        return [
            (v["diagonal"], v["diagonal"], v["diagonal"] + n, 1.0)
            for v, own in zip(votes, hits)
            if _whole(own, n_grams, v, template)
        ]
    least = max(n_grams - PASSAGE_GRAM * slack, 1)
    places: list[tuple[int, int, int, float]] = []
    low = high = 0
    for i, middle in enumerate(votes):
        at = middle["diagonal"]
        while votes[low]["diagonal"] < at - slack:
            low += 1
        while high < len(votes) and votes[high]["diagonal"] <= at + slack:
            high += 1
        if len(set().union(*hits[low:high])) < least:
            continue
        if max(range(low, high), key=lambda j: (len(hits[j]), -j)) != i:
            continue
        if _whole(hits[i], n_grams, middle, template):
            places.append((at, at, at + n, 1.0))
            continue
        edits, first, end = align(template, list(middle["window"]))
        if edits <= slack:
            places.append((at, middle["first"] + first, middle["first"] + end, 1 - edits / n))

    def outdone(i: int) -> bool:
        """By a place that shares words with this one."""
        own, (_, first, end, similarity) = (-places[i][3], places[i][1], i), places[i]
        for step in (-1, 1):
            j = i + step
            while 0 <= j < len(places) and abs(places[j][0] - places[i][0]) <= n + 2 * slack:
                other = places[j]
                if other[1] < end and first < other[2] and (-other[3], other[1], j) < own:
                    return True
                j += step
        return False

    return [p for i, p in enumerate(places) if not outdone(i)]


def reach(n_words: int) -> int:
    """Diagonals beside its own on which a place depends: those of places that may overlap it,
    and of the votes that these take in."""
    slack = edits_allowed(n_words)
    return n_words + 3 * slack if slack else 0


def license_spans(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """(doc_id, row_key, label, base, first_word, end_word, similarity) of every verified span."""
    spark = docs.sparkSession
    at = F.when(F.col("i") < F.col("n_pairs"), F.col("i")).otherwise(F.col("i") - F.col("n_pairs"))
    first_range, last_range = [F.floor((F.col("diagonal") + by * F.col("reach")) / RANGE) for by in (-1, 1)]
    diagonal = F.col("p") - F.col("t")
    first = F.greatest(diagonal - F.col("slack"), F.lit(0))
    kind = docs.schema["doc_id"].dataType.simpleString()
    votes = (
        _grams(docs)
        .select("doc_id", "row_key", "words", "n_pairs", F.posexplode("grams").alias("i", "gram"))
        .join(F.broadcast(_template_grams(spark, templates)), "gram")
        .withColumn("p", at)
        .select(
            "doc_id",
            "row_key",
            "template",
            "t",
            diagonal.alias("diagonal"),
            first.alias("first"),
            F.slice("words", first + 1, diagonal + F.col("n") + F.col("slack") - first).alias("window"),
            "reach",
        )
        .groupBy("doc_id", "row_key", "template", "diagonal")
        .agg(
            F.collect_set("t").alias("hits"),
            F.first("first").alias("first"),
            F.first("window").alias("window"),
            F.first("reach").alias("reach"),
        )
        .withColumn("range", F.explode(F.sequence(first_range, last_range)))
        .groupBy("doc_id", "row_key", "template", "range")
        .agg(F.collect_list(F.struct("diagonal", "hits", "first", "window")).alias("votes"))
    )
    known = [word_hashes(t.text).view(np.int64).tolist() for t in templates]

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "row_key", "label", "base", "first_word", "end_word", "similarity"]
        for batch in batches:
            rows, out = [], []
            numbers, ranges = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for i, (number, own, votes) in enumerate(zip(numbers, ranges, batch.column(4))):
                for diagonal, *place in verified_places(votes.as_py(), known[number]):
                    if diagonal // RANGE == own:
                        rows.append(i)
                        out.append((templates[number].label, templates[number].base, *place))
            values = list(zip(*out)) if out else [[]] * 5
            index = pa.array(rows, pa.int64())
            types = [pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(index),
                    batch.column(1).take(index),
                    *[pa.array(v, t) for v, t in zip(values, types)],
                ],
                names=names,
            )

    return votes.mapInArrow(
        verify,
        f"doc_id {kind}, row_key long, label string, base boolean, first_word long, end_word long, "
        "similarity double",
    )


def word_counts(docs: DataFrame) -> DataFrame:
    """(doc_id, row_key, n_words) of every row."""
    source = docs.select("doc_id", F.xxhash64("text").alias("row_key"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [np.zeros(0, np.int64)]
            for block in blocks(batch.column(2)):
                starts, _ = spans(block, IS_ALNUM[LOWER[block.data]])
                counts.append(np.diff(first_words(block.row_of(starts), block.rows)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.concatenate(counts), pa.int64())],
                names=["doc_id", "row_key", "n_words"],
            )

    return source.mapInArrow(run, f"doc_id {kind}, row_key long, n_words long")


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, n_base (places of base phrases), the first and
    last word such a place begins at, base_labels, labels, and score, the best similarity."""
    base = F.col("base")
    per_doc = (
        license_spans(docs, templates)
        .groupBy(F.col("doc_id").alias("_id"), F.col("row_key").alias("_key"))
        .agg(
            F.count(F.when(base, 1)).alias("n_base"),
            F.min(F.when(base, F.col("first_word"))).alias("first_word"),
            F.max(F.when(base, F.col("first_word"))).alias("last_word"),
            F.array_join(F.sort_array(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
            F.array_join(F.sort_array(F.collect_set("label")), ",").alias("labels"),
            F.max("similarity").alias("score"),
        )
    )
    counts = word_counts(docs)
    joined = counts.join(
        per_doc, counts["doc_id"].eqNullSafe(per_doc["_id"]) & (counts["row_key"] == per_doc["_key"]), "left"
    )
    return joined.select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
