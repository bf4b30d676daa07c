"""Importance resampling: documents whose words are likely under a target are drawn more often.

Features are runs of one and two words, hashed to `BUCKETS` buckets. A bucket's gain is the
(scaled) logarithm of its share in the target texts over its share in the documents; a document's
weight is the mean gain of its features. Adding Gumbel noise, made from the document's id, and
taking the highest sums draws without replacement in proportion to the weights' exponentials.

Corpus counts are made by segments. Texts are cut at line breaks, which separate words anyway;
lines are brought to a normal form (their words, lower-case, one space between) and counted, and
the features of each distinct line are made once and multiplied by the line's occurrences. Two-word
runs that cross a line break are segments of their own: the last word of a line and the first of the
next line that has words. Both kinds are counted in one aggregate with partial sums before the
shuffle, so a line that stands in a third of all rows costs each map task one row, as does a copied
document. What leaves it is one row per bucket.

Weights are then a map over the documents, as gains are a fixed number of figures (BUCKETS) that
travel with the plan. Ranks come from narrow rows, range-partitioned by score and stored: a row's
rank is its place in its partition and the number of rows in the partitions before.

Defined cases: a null or empty text, or one without words, has no features, weight 0, a score, and
is never drawn, as are texts under `min_words`; a null id makes its noise from the empty string, and
is smaller than any other id; rows with one id share their noise, rank by a hash of their text, and
repeated rows are each ranked; an empty table gives no rows; empty targets give every bucket the same
gain but for the documents' own counts. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.operators.sizing import fits_broadcast
from martloom.sources.scratch import stored

BUCKETS = 10_000
# What stands between words, but for the line break.
GAPS = r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+"
_PLACES = (1 << 33) - 1  # of a row's number within its partition


def lines_of(text: Column) -> Column:
    """The text's lines that have words, in normal form."""
    lower = F.translate(F.coalesce(text, F.lit("")), ascii_uppercase, ascii_lowercase)
    lines = F.split(F.regexp_replace(lower, GAPS, " "), "\n")
    return F.filter(F.transform(lines, lambda x: F.trim(x)), lambda line: line != "")


def _neighbours(items: Column, join) -> Column:
    n = F.greatest(F.size(items) - 1, F.lit(0))
    return F.zip_with(F.slice(items, F.lit(1), n), F.slice(items, F.lit(2), n), join)


def _bucket(feature: Column) -> Column:
    return F.pmod(F.crc32(feature), F.lit(BUCKETS)).cast("int")


def _buckets_of(words: Column) -> Column:
    """Buckets of all runs of one and two words."""
    pairs = _neighbours(words, lambda a, b: _bucket(F.concat(a, F.lit(" "), b)))
    return F.concat(F.transform(words, _bucket), pairs)


def segment_counts(texts: DataFrame) -> DataFrame:
    """(segment, crossing, n): distinct lines, and pairs of words across line breaks, of `text`."""
    lines = texts.select(lines_of(F.col("text")).alias("lines"))
    last, first = (lambda x: F.substring_index(x, " ", -1)), (lambda x: F.substring_index(x, " ", 1))
    crossing = _neighbours(F.col("lines"), lambda a, b: F.concat(last(a), F.lit(" "), first(b)))

    def marked(segments: Column, flag: bool) -> Column:
        return F.transform(
            segments, lambda s: F.struct(s.alias("segment"), F.lit(flag).alias("crossing"))
        )

    segments = F.concat(marked(F.col("lines"), False), marked(crossing, True))
    return lines.select(F.inline(segments)).groupBy("segment", "crossing").agg(F.count(F.lit(1)).alias("n"))


def bucket_counts(texts: DataFrame) -> DataFrame:
    """(bucket, n): how many features of all texts fall in each bucket that has some."""
    own = F.when(F.col("crossing"), F.array(_bucket(F.col("segment")))).otherwise(
        _buckets_of(F.split("segment", " "))
    )
    counts = segment_counts(texts).select(F.explode(own).alias("bucket"), "n")
    return counts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame) -> list[int]:
    """Thousandths of the log ratio of a bucket's smoothed shares in target and documents."""
    spark = docs.sparkSession
    s = bucket_counts(docs).withColumnRenamed("n", "s")
    t = bucket_counts(target).withColumnRenamed("n", "t")
    counts = stored(s.join(t, "bucket", "full"))  # at most BUCKETS rows
    count = {c: F.coalesce(F.col(c), F.lit(0)).cast("double") for c in ("s", "t")}
    size = counts.agg(*(F.coalesce(F.sum(c), F.lit(0)).cast("double").alias(c) for c in ("s", "t"))).first()
    share = (count["t"] + 1) * (size["s"] + BUCKETS) / ((count["s"] + 1) * (size["t"] + BUCKETS))
    every = spark.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    rows = every.join(counts, "bucket", "left").select("bucket", F.floor(1000 * F.log(share)).alias("gain"))
    gain = dict(rows.collect())
    return [gain[bucket] for bucket in range(BUCKETS)]


def weighted(docs: DataFrame, gain: list[int], seed: int = 7) -> DataFrame:
    """doc_id, n_words, n_features, weight and score (weight and noise) of every row of `docs`."""
    table = F.expr(f"array({','.join(f'{g}L' for g in gain)})")
    words = F.split(F.concat_ws(" ", lines_of(F.col("text"))), " ")
    rows = docs.select(
        "doc_id", F.xxhash64("text").alias("text_key"), F.filter(words, lambda w: w != "").alias("words")
    )
    total = F.aggregate(_buckets_of(F.col("words")), F.lit(0).cast("long"), lambda sum_, b: sum_ + F.get(table, b))
    rows = rows.select(
        "doc_id", "text_key", F.size("words").cast("long").alias("n_words"), total.alias("total")
    )
    rows = rows.withColumn("n_features", F.greatest(2 * F.col("n_words") - 1, F.lit(0)))
    mean = F.expr("(total - pmod(total, n_features)) div n_features")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    uniform = (F.conv(F.left(digest, F.lit(8)), 16, 10).cast("double") + 0.5) / 4294967296.0
    noise = F.floor(-1000 * F.log(-F.log(uniform))).cast("long")
    rows = rows.withColumn("weight", F.when(F.col("n_features") > 0, mean).otherwise(F.lit(0)).cast("long"))
    return rows.drop("total").withColumn("score", F.col("weight") + noise)


def drawn(scored: DataFrame, percent: int, min_words: int) -> DataFrame:
    """`scored` with `rank`, from 1 for the highest score, of the share of eligible rows drawn."""
    order = [
        F.col("eligible").desc(),
        F.col("score").desc(),
        F.col("doc_id").asc_nulls_first(),
        F.col("text_key").asc(),
    ]
    # Stored first, as finding the bounds of the ranges would compute the scores once more.
    rows = stored(scored.withColumn("eligible", F.col("n_words") >= min_words))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = stored(
        rows.withColumns(
            {
                "part": F.spark_partition_id(),
                "place": F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACES)),
            }
        )
    )
    # One row per partition.
    sizes = rows.groupBy("part").agg(F.count_if("eligible").alias("size"))
    parts = Window.orderBy("part")
    before = F.sum("size").over(parts.rowsBetween(Window.unboundedPreceding, -1))
    everything = F.sum("size").over(parts.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    sizes = sizes.select(
        "part",
        F.coalesce(before, F.lit(0)).alias("before"),
        ((everything * percent - F.pmod(everything * percent, F.lit(100))) / 100).cast("long").alias("quota"),
    )
    if fits_broadcast(sizes):
        sizes = F.broadcast(sizes)
    rank = F.col("before") + F.col("place") + 1
    takes = F.col("eligible") & (rank <= F.col("quota"))
    return rows.join(sizes, "part").select(*scored.columns, F.when(takes, rank).alias("rank"))


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 25, min_words: int = 20, seed: int = 7
) -> DataFrame:
    """Every row of `docs` with its features, weight and score, and the rank of those drawn."""
    return drawn(weighted(docs, gains(docs, target), seed), percent, min_words)
