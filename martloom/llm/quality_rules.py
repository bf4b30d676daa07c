"""Quality rules whose cutoffs come with a proven bound on false rejections.

Every rule compares one figure of a text with a cutoff and rejects what lies above it. Cutoffs
are chosen per stratum (the language column) from labelled documents that pass the base rules:

1. Labelled documents are dealt to two folds by a hash of their id. On the *tuning* fold each
   rule finds the cutoff with the best trade of bad documents caught against good ones lost.
   It also fixes a path on which the stratum's cutoffs are loosened one at a time until none is
   left: next comes the one that rejects the most good documents of that fold.
2. On the *holdout* fold, which played no part in that choice, the exact (Clopper-Pearson)
   upper bound on the share of good documents that *any* of the stratum's cutoffs rejects must
   not exceed `max_false`. If it does, the next place of the path is tried; what is rejected only
   shrinks along it, so this fixed sequence costs no further correction.
3. Each test is made at level `risk / proposals` (Bonferroni; there are no more tests than that),
   the proposals being the pairs of stratum and rule for which the tuning fold found any use, so
   that with probability 1 - risk *all* rules of every stratum together keep its bound. A stratum
   with too few good labelled documents for that certifies nothing and loses nothing but what the
   base rules reject.

Counting is one grouped aggregate over the labelled documents; what the last step sees is a
table of strata x rules x cutoffs, and of strata x places on their paths.

Defined cases: a null text has no words and fails the base rules; a null stratum is a stratum
of its own; labels without id or quality are ignored, an id labelled both ways counts as good,
and a label holds for every row with its id; repeated rows are judged alike.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.words import (
    NO_SPACE,
    blocks,
    byte_table,
    first_words,
    gram_hashes,
    lines,
    mixed,
    span_hashes,
    spans,
)
from martloom.operators.sizing import fits_broadcast
from martloom.sources.scratch import stored

COUNTS = (
    "n_words word_chars n_symbols n_lines n_dup_lines n_repeat_words n_letters n_upper n_exclaims"
).split()
WINDOW = 8

_SYMBOL = byte_table(b"#*$%&|<>")
_UPPER = byte_table(range(65, 91))
_LETTER = byte_table([*range(65, 91), *range(97, 123)])
_EXCLAIM = byte_table(b"!")
_CODE_POINT = ~byte_table(range(0x80, 0xC0))


@dataclass(frozen=True)
class Rule:
    """Rejects a document whose `value` is above the cutoff; `cutoffs` run from tight to loose."""

    name: str
    value: str
    cutoffs: tuple[float, ...]


_SHARES = (0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)
RULES = (
    Rule("symbols", "n_symbols / greatest(n_words, 1)", (0.05, 0.1, 0.2, 0.3, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0)),
    Rule("exclaims", "n_exclaims / greatest(n_words, 1)", (0.05, 0.1, 0.2, 0.3, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0)),
    Rule("upper_case", "n_upper / greatest(n_letters, 1)", _SHARES),
    Rule("repeated_lines", "n_dup_lines / greatest(n_lines, 1)", _SHARES),
    Rule("repeated_words", "n_repeat_words / greatest(n_words, 1)", _SHARES),
    Rule("long_words", "word_chars / greatest(n_words, 1)", (8, 9, 10, 11, 12, 14, 16, 20, 30, 50)),
)


@dataclass(frozen=True)
class Risk:
    """`max_false`: share of good documents all rules together may reject in a stratum; `risk`:
    chance that any bound fails; `loss_weight`: good documents lost count so many times as much as bad
    ones caught; `stratum`: column whose values are judged apart."""

    max_false: float = 0.02
    risk: float = 0.05
    loss_weight: float = 10.0
    stratum: str = "lang"
    rules: tuple[Rule, ...] = field(default=RULES)


def _block_counts(block) -> dict[str, np.ndarray]:
    data, n = block.data, block.rows
    no_space = NO_SPACE[data]
    starts, ends = spans(block, no_space)
    rows = block.row_of(starts)
    firsts = first_words(rows, n)
    out = {
        "n_words": firsts[1:] - firsts[:-1],
        "word_chars": block.per_row(no_space & _CODE_POINT[data]),
        "n_symbols": block.per_row(_SYMBOL[data]),
        "n_letters": block.per_row(_LETTER[data]),
        "n_upper": block.per_row(_UPPER[data]),
        "n_exclaims": block.per_row(_EXCLAIM[data]),
    }

    line_rows, line_starts, line_ends = lines(block)
    with_word = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    line_rows, line_starts, line_ends = (x[with_word] for x in (line_rows, line_starts, line_ends))
    keys = span_hashes(data, line_starts, line_ends) ^ mixed(line_rows)
    out["n_lines"] = np.bincount(line_rows, minlength=n)
    out["n_dup_lines"] = np.bincount(line_rows[pd.Series(keys).duplicated()], minlength=n)

    grams = gram_hashes(span_hashes(data, starts, ends), WINDOW)
    whole = rows[: len(grams)] == rows[WINDOW - 1 :] if len(grams) else np.zeros(0, bool)
    at = np.flatnonzero(whole)
    twice = at[pd.Series(grams[at] ^ mixed(rows[at])).duplicated(keep=False)]
    change = np.zeros(len(starts) + 1, np.int64)
    change[twice] += 1
    np.subtract.at(change, twice + WINDOW, 1)
    out["n_repeat_words"] = np.bincount(rows[np.cumsum(change)[:-1] > 0], minlength=n)
    return out


def text_counts(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """`keep` columns and COUNTS of every whole text (words are compared by 64-bit hashes)."""
    source = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("_text"))
    schema = source.drop("_text").schema
    for name in COUNTS:
        schema = schema.add(name, "long")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [_block_counts(b) for b in blocks(batch.column(len(keep)))]
            counts = [
                pa.array(np.concatenate([p[c] for p in parts]) if parts else [], pa.int64())
                for c in COUNTS
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], *counts], names=[*keep, *COUNTS]
            )

    return source.mapInArrow(count, schema)


def base_failed() -> Column:
    """Fewer than 20 words, or over 30 % of them in windows that repeat."""
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Binomial(n, p), summed down from k until terms no longer count."""
    if k >= n:
        return 1.0
    if k > n * p:
        return 1.0  # at least about one half: never below a level that is asked for
    log_term = (
        math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
        + k * math.log(p) + (n - k) * math.log1p(-p)
    )
    ratio, total, i = 1.0, 0.0, k
    while i >= 0 and ratio > total * 1e-17:
        total += ratio
        ratio *= i * (1 - p) / ((n - i + 1) * p)
        i -= 1
    return math.exp(log_term) * total


def certified(false_rejections: int, good: int, max_false: float, level: float) -> bool:
    """Whether the exact upper bound at confidence 1 - level is at most `max_false`."""
    return good > 0 and binomial_tail(false_rejections, good, max_false) <= level


def _above(counts: np.ndarray) -> np.ndarray:
    """Documents above each cutoff, from those by number of cutoffs exceeded (last axis)."""
    return counts[..., ::-1].cumsum(-1)[..., ::-1]


def propose_cutoff(tuning: np.ndarray, loss_weight: float) -> int | None:
    """Index of the best cutoff on the tuning fold, the loosest of equals, from
    tuning[good, cutoffs exceeded]; None if no cutoff gains anything."""
    above = _above(tuning)
    share = above[:, 1:] / np.maximum(above[:, :1], 1)
    gain = share[0] - loss_weight * share[1]
    best = len(gain) - 1 - int(np.argmax(gain[::-1]))
    return best if gain[best] > 0 else None


def certified_cutoff(held: np.ndarray, best: int, max_false: float, level: float) -> int | None:
    """The tightest cutoff, from the proposed one on, that held[cutoffs exceeded], the good
    documents of the holdout fold, certify."""
    above = _above(held)
    for j in range(best, len(held) - 1):
        if certified(int(above[j + 1]), int(above[0]), max_false, level):
            return j
    return None


def loosening(tuning: list[np.ndarray], loss_weight: float) -> list[list[int]]:
    """Per rule, and number of its cutoffs a document exceeds, the place on the stratum's path
    from which on the rule rejects no such document; 0: it never does. Empty: not proposed."""
    places: list[list[int]] = [[] for _ in tuning]
    at, shares = {}, {}
    for number, counts in enumerate(tuning):
        best = propose_cutoff(counts, loss_weight)
        if best is not None:
            above = _above(counts)
            at[number] = best
            shares[number] = above[:, 1:] / np.maximum(above[:, :1], 1)
            places[number] = [0] * (best + 1)
    place = 0
    while at:
        # The one that loses the most good documents, and of these that catches the fewest bad.
        number = max(at, key=lambda i: (shares[i][1, at[i]], -shares[i][0, at[i]], i))
        place += 1
        at[number] += 1
        places[number].append(place)
        if at[number] == shares[number].shape[1]:
            del at[number]
    return places


def certified_cutoffs(counts: DataFrame, labels: DataFrame, risk: Risk) -> DataFrame:
    """(stratum, rule, cutoff, good, lost) of the rules that are certified; of the holdout's good
    documents all the stratum's rules together reject `lost`."""
    marked = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy(F.col("doc_id").alias("_id"))
        .agg(F.max((F.col("quality") > 0).cast("int")).alias("_good"))
    )
    labelled = counts.where(~base_failed()).join(marked, F.col("doc_id") == F.col("_id"))
    above = F.array(
        *[sum((F.expr(r.value) > c).cast("int") for c in r.cutoffs) for r in risk.rules]
    )
    # Any engine can repeat this hash: the last bit of its first 60.
    ticket = F.md5(F.concat(F.lit("fold|"), F.col("doc_id").cast("string")))
    fold = (F.conv(F.substring(ticket, 1, 15), 16, 10).cast("long") % 2).cast("int")
    table = stored(
        labelled.select("stratum", fold.alias("fold"), "_good", above.alias("above"))
        .groupBy("stratum", "fold", "_good", "above")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    tuning = (
        table.where("fold = 0")
        .select("stratum", "_good", "n", F.posexplode("above").alias("rule", "above"))
        .groupBy("stratum", "rule", "_good", "above")
        .agg(F.sum("n").alias("n"))
    )

    def propose(rows: pd.DataFrame) -> pd.DataFrame:
        tuned = []
        for number, rule in enumerate(risk.rules):
            own = rows[rows["rule"] == number]
            counts = np.zeros((2, len(rule.cutoffs) + 1), np.int64)
            np.add.at(counts, (own["_good"], own["above"]), own["n"])
            tuned.append(counts)
        places = loosening(tuned, risk.loss_weight)
        found = [(rows["stratum"].iloc[0], places)] if any(places) else []
        return pd.DataFrame(found, columns=["stratum", "places"])

    kind = counts.schema["stratum"].dataType.simpleString()
    proposals = stored(
        tuning.groupBy("stratum").applyInPandas(propose, f"stratum {kind}, places array<array<int>>")
    )
    proposed = F.size(F.filter("places", lambda p: F.size(p) > 0))
    level = risk.risk / max(1, proposals.agg(F.sum(proposed)).first()[0] or 0)

    paths = proposals.withColumnRenamed("stratum", "_stratum")
    if fits_broadcast(paths):
        paths = F.broadcast(paths)
    left_at = F.array_max(F.zip_with("places", "above", lambda p, n: F.coalesce(F.get(p, n), F.lit(0))))
    held = (
        table.where("fold = 1 AND _good = 1")
        .join(paths, F.col("stratum").eqNullSafe(F.col("_stratum")))
        .groupBy("stratum", "places", left_at.cast("long").alias("place"))
        .agg(F.sum("n").alias("n"))
        .groupBy("stratum", "places")
        .agg(F.collect_list(F.array("place", "n")).alias("held"))
    )

    def certify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            found = []
            for row in rows.itertuples():
                last = max(p[-1] for p in row.places if len(p))
                held = np.zeros(last + 1, np.int64)
                for place, n in row.held:
                    held[place] += n
                place = certified_cutoff(held, 0, risk.max_false, level)
                if place is None:
                    continue
                good, lost = int(held.sum()), int(held[place + 1 :].sum())
                for rule, own in zip(risk.rules, row.places):
                    j = sum(p <= place for p in own) - 1
                    if 0 <= j < len(rule.cutoffs):
                        found.append((row.stratum, rule.name, rule.cutoffs[j], good, lost))
            yield pd.DataFrame(found, columns=["stratum", "rule", "cutoff", "good", "lost"])

    return held.mapInPandas(
        certify, f"stratum {kind}, rule string, cutoff double, good long, lost long"
    )


def judge(docs: DataFrame, labels: DataFrame, risk: Risk = Risk()) -> DataFrame:
    """One row per row of `docs`: doc_id, stratum, `row_key` (a hash of the whole text), COUNTS,
    base_failed, failed_rules and kept."""
    counts = stored(
        text_counts(
            docs.select(
                "doc_id",
                F.col(risk.stratum).alias("stratum"),
                F.xxhash64("text").alias("row_key"),
                "text",
            ),
            ["doc_id", "stratum", "row_key"],
        )
    )
    cutoffs = stored(
        certified_cutoffs(counts, labels, risk)
        .groupBy(F.col("stratum").alias("_stratum"))
        .agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("_cutoffs"))
    )
    if fits_broadcast(cutoffs):
        cutoffs = F.broadcast(cutoffs)
    judged = counts.join(cutoffs, F.col("stratum").eqNullSafe(F.col("_stratum")), "left")
    broken = [
        F.when(F.expr(r.value) > F.col("_cutoffs")[r.name], F.lit(r.name)) for r in risk.rules
    ]
    failed = F.when(
        base_failed(), F.lit("base")
    ).otherwise(F.concat_ws(",", *broken))
    return judged.select(
        "doc_id",
        "stratum",
        "row_key",
        *COUNTS,
        base_failed().alias("base_failed"),
        failed.alias("failed_rules"),
        (failed == "").alias("kept"),
    )


def accepted(docs: DataFrame, labels: DataFrame, risk: Risk = Risk()) -> DataFrame:
    """The rows of `docs` that are kept, with all their columns."""
    kept = judge(docs, labels, risk).where("kept")
    kept = kept.select(F.col("doc_id").alias("_id"), F.col("row_key").alias("_key")).distinct()
    return docs.join(
        kept,
        docs["doc_id"].eqNullSafe(kept["_id"]) & (F.xxhash64(docs["text"]) == kept["_key"]),
        "left_semi",
    )
