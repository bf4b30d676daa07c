"""Language identification by fusing evidence in one Bayesian score.

For every record and language l

    log P(l | record) = log P(l | host) + log P(declared | l) + log P(text | l) / temper + const

* P(text | l): byte 3-grams hashed to `BUCKETS`, with add-one smoothing, counted over *all*
  labelled documents by a grouped aggregate. Overlapping 3-grams repeat each other, hence the
  tempering.
* P(declared | l): how often records whose text looks like l declare that language (the `lang`
  attribute of the markup, or a table's language column), missing declarations being a value of
  their own, smoothed towards the declaration's overall share.
* P(l | host): counts of text languages on the host, smoothed towards its address suffix, which
  is smoothed towards all records; a record's own count is taken out. A host with few records
  thus follows its suffix, and one without any follows the whole corpus.

A text that is itself labelled would be judged by what it taught. Labelled texts may therefore be dealt
to folds: each is scored by the model of the other folds, and unlabelled ones by the model of all.

All counts are grouped aggregates with partial sums before the shuffle. What reaches the driver
is the model: BUCKETS 4-byte figures for every labelled language (and fold), all of which are kept. A record's
scores, 8 bytes for each language, are stored between the two passes; counts by language hold only
the languages that occur, and no plan grows with the number of languages.

Defined cases: a record without text, url or declaration is judged by what is left; null or
unreadable hosts share one host and suffix (the empty one); a null id is an id like any other; repeated
rows each count and are each returned; without labelled texts all languages are null.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from martloom.llm.words import LOWER, Block, blocks
from martloom.operators.sizing import fits_broadcast
from martloom.sources.scratch import stored

BUCKETS = 1 << 13
# Scores of so many records times languages leave a worker at once.
SCORES_PER_BATCH = 1 << 20
TEMPER = 4.0
# Records an upper level of the host prior counts for, and a declaration's share counts for.
PRIOR_RECORDS = 5.0

# Everything in ASCII but letters counts as a space.
_PLAIN = LOWER.copy()
_PLAIN[[b for b in range(128) if not chr(b).isalpha()]] = 32


def _buckets(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the 3-gram from every byte on, and which of them lie within one row."""
    data = _PLAIN[block.data].astype(np.uint32)
    grams = np.zeros(len(data), np.uint32)
    if len(data) < 3:
        return grams, np.zeros(len(data), bool)
    grams[:-2] = (data[:-2] << 16) | (data[1:-1] << 8) | data[2:]
    inside = grams != 0x202020
    ends = block.bounds[1:]
    for back in (1, 2):
        at = ends - back
        inside[at[at >= block.bounds[:-1]]] = False
    return (grams * np.uint32(0x9E3779B1)) >> np.uint32(32 - 13), inside


def gram_counts(texts: DataFrame) -> DataFrame:
    """(lang, bucket, n) over the rows of `texts` (lang, text)."""
    source = texts.where("lang IS NOT NULL AND lang <> ''").select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            codes = batch.column(0).dictionary_encode()
            names = codes.dictionary.to_pylist()
            code = np.asarray(codes.indices)
            for block in blocks(batch.column(1)):
                buckets, inside = _buckets(block)
                own = np.repeat(code[block.first : block.first + block.rows], np.diff(block.bounds))
                both = np.bincount(
                    own[inside].astype(np.int64) * BUCKETS + buckets[inside],
                    minlength=len(names) * BUCKETS,
                ).reshape(-1, BUCKETS)
                for name, row in zip(names, both):
                    counts[name] = counts.get(name, 0) + row
        for name, row in counts.items():
            used = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(used), pa.string()), pa.array(used, pa.int32()), pa.array(row[used], pa.int64())],
                names=["lang", "bucket", "n"],
            )

    parts = source.mapInArrow(run, "lang string, bucket int, n long")
    return parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def train(texts: DataFrame, folds: int = 0) -> tuple[list[str], np.ndarray]:
    """Languages, in order, and log P(bucket | language). With `folds`, texts have a `fold` (from 0 to
    folds - 1), and there is a model for each fold, learned from the others, and last one of all."""
    fold = F.col("fold") if folds else F.lit(0)
    keyed = texts.where("lang IS NOT NULL AND lang <> ''").select(
        F.concat_ws(":", fold.cast("int"), "lang").alias("lang"), "text"
    )
    counts = stored(
        gram_counts(keyed).select(
            F.regexp_extract("lang", r"(?s)^\d+:(.*)$", 1).alias("lang"),
            F.substring_index("lang", ":", 1).cast("int").alias("fold"),
            "bucket",
            "n",
        )
    )
    langs = sorted(row["lang"] for row in counts.select("lang").distinct().collect())
    model = np.zeros((folds + 1, len(langs), BUCKETS), np.float32)
    index = {lang: i for i, lang in enumerate(langs)}

    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for without in range(folds + 1):
            part = rows[rows["fold"] != without] if without < folds else rows
            own = np.ones(BUCKETS, np.float64)
            np.add.at(own, part["bucket"], part["n"])
            row = np.log(own / own.sum()).astype(np.float32)
            out.append((rows["lang"].iloc[0], without, row.tobytes()))
        return pd.DataFrame(out, columns=["lang", "without", "row"])

    rows = counts.groupBy("lang").applyInPandas(learn, "lang string, without int, row binary")
    for row in rows.toLocalIterator():
        model[row["without"], index[row["lang"]]] = np.frombuffer(row["row"], np.float32)
    return langs, model if folds else model[0]


def text_scores(records: DataFrame, langs: list[str], model: np.ndarray) -> DataFrame:
    """`records` with `scores`, the log likelihood of the text under each language, instead of
    the text. With models by fold, a record's `fold` picks one: null the one of all texts."""
    keep = [c for c in records.columns if c != "text"]
    by_fold = model.ndim == 3
    models = model if by_fold else model[None]
    fold = F.coalesce("fold", F.lit(len(models) - 1)) if by_fold else F.lit(0)
    source = records.select(*keep, "text", fold.cast("int").alias("_model"))
    shared = records.sparkSession.sparkContext.broadcast(models)
    n_langs = len(langs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            step = max(1, SCORES_PER_BATCH // n_langs)
            for first in range(0, batch.num_rows, step):
                part = batch.slice(first, step)
                which = part.column(len(keep) + 1).to_numpy()
                parts = [np.zeros((0, n_langs))]
                for block in blocks(part.column(len(keep))):
                    buckets, inside = _buckets(block)
                    scores = np.zeros((block.rows, n_langs))
                    own = which[block.first : block.first + block.rows]
                    for k in np.unique(own):
                        rows = own == k
                        for i in range(n_langs):
                            found = np.where(inside, table[k][i][buckets], 0).astype(np.float64)
                            scores[rows, i] = block.per_row(found)[rows]
                    parts.append(scores)
                scores = np.concatenate(parts)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(scores) + 1) * n_langs, pa.int32()), pa.array(scores.ravel())
                )
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[: len(keep)], lists], names=[*keep, "scores"]
                )

    return source.mapInArrow(run, source.drop("text", "_model").schema.add("scores", ArrayType(DoubleType())))


def page_text(html: Column) -> Column:
    """What a page shows: no scripts, styles, comments and tags."""
    hidden = r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>"
    return F.regexp_replace(F.coalesce(html, F.lit("")), hidden, " ")


def declared_language(html: Column) -> Column:
    """The `lang` of the html tag, if that is no part of a comment."""
    shown = F.regexp_replace(html, r"(?s)<!--.*?(?:-->|\z)", " ")
    tag = F.regexp_extract(shown, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})\b", 1)
    return F.nullif(F.lower(tag), F.lit(""))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.coalesce(F.lower(host), F.lit(""))


def suffix_of(host: Column) -> Column:
    return F.regexp_extract(host, r"\.([^.]+)$", 1)


def _counts_by(scored: DataFrame, key: str) -> DataFrame:
    """`key`, n and `by_lang`, the number of records per text language that occurs."""
    counts = scored.groupBy(key, "guess").agg(F.count(F.lit(1)).alias("n"))
    by_lang = F.map_from_entries(F.collect_list(F.struct("guess", "n")))
    return counts.groupBy(key).agg(F.sum("n").alias("n"), by_lang.alias("by_lang"))


def _join_counts(scored: DataFrame, counts: DataFrame, key: str, name: str) -> DataFrame:
    renamed = counts.select(
        F.col(key).alias("_key"), F.col("n").alias(f"{name}_n"), F.col("by_lang").alias(f"{name}_by")
    )
    renamed = stored(renamed)
    if fits_broadcast(renamed):
        renamed = F.broadcast(renamed)
    return scored.join(renamed, scored[key].eqNullSafe(renamed["_key"]), "left").drop("_key")


def identify(records: DataFrame, langs: list[str], model: np.ndarray) -> DataFrame:
    """`records` (any columns, and text, declared, host, suffix; fold with models by fold) with
    text_lang, lang and posterior instead of text and of own columns of these names."""
    own = [c for c in records.columns if c.lower() not in ("text", "text_lang", "lang", "posterior")]
    if not langs:
        none = F.lit(None).cast("string")
        return records.select(
            *[F.col(f"`{c}`") for c in own],
            none.alias("text_lang"),
            none.alias("lang"),
            F.lit(None).cast("double").alias("posterior"),
        )
    n_langs = len(langs)
    names = F.from_json(F.lit(json.dumps(langs)), "array<string>")
    # Other columns go along as one value, so that they cannot clash with those made here.
    used = ["declared", "host", "suffix"]
    other = [c for c in own if c not in used]
    scored = text_scores(
        records.select(
            F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in other]).alias("record"),
            *used,
            *(["fold"] if model.ndim == 3 else []),
            "text",
        ),
        langs,
        model,
    )
    best = F.array_position("scores", F.array_max("scores")).cast("int") - 1
    scored = stored(scored.withColumn("guess", best))

    everything = scored.groupBy("guess").agg(F.count(F.lit(1)).alias("n")).collect()
    totals = np.zeros(n_langs)
    for row in everything:
        totals[row["guess"]] = row["n"]
    world = (totals + 1) / (totals.sum() + n_langs)

    rows = _join_counts(scored, _counts_by(scored, "host"), "host", "host")
    rows = _join_counts(rows, _counts_by(scored, "suffix"), "suffix", "suffix")
    rows = _join_counts(rows, _counts_by(scored, "declared"), "declared", "declared")

    n_all = float(max(totals.sum(), 1))
    shares = F.from_json(F.lit(json.dumps(world.tolist())), "array<double>")
    sizes = F.from_json(F.lit(json.dumps(totals.tolist())), "array<double>")

    def log_evidence(score: Column, i: Column) -> Column:
        own = (F.col("guess") == i).cast("long")

        def count(name: str) -> Column:
            return F.coalesce(F.try_element_at(f"{name}_by", i), F.lit(0))

        by_suffix = (count("suffix") - own + PRIOR_RECORDS * F.get("_shares", i)) / (
            F.col("suffix_n") - 1 + PRIOR_RECORDS
        )
        by_host = (count("host") - own + PRIOR_RECORDS * by_suffix) / (
            F.col("host_n") - 1 + PRIOR_RECORDS
        )
        share = F.col("declared_n") / n_all
        declares = (count("declared") + PRIOR_RECORDS * share) / (F.get("_sizes", i) + PRIOR_RECORDS)
        return F.log(by_host) + F.log(declares) + score / TEMPER

    rows = rows.withColumn("_shares", shares).withColumn("_sizes", sizes)
    fused = rows.withColumn("logs", F.transform("scores", log_evidence))
    fused = fused.withColumn("top", F.array_max("logs"))
    place = F.array_position("logs", F.col("top")).cast("int") - 1
    rest = F.aggregate("logs", F.lit(0.0), lambda s, x: s + F.exp(x - F.col("top")))
    # A projection of its own: within a lambda a name may mean a column being made beside it.
    fused = fused.withColumn("posterior", F.try_divide(F.lit(1.0), rest))
    return fused.select(
        *[F.col(c) if c in used else F.col("record").getField(c).alias(c) for c in own],
        F.get(names, F.col("guess")).alias("text_lang"),
        F.get(names, place).alias("lang"),
        "posterior",
    )
