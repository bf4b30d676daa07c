"""Mixing sources to target weights by Sainte-Laguë apportionment.

1. Targets: sources share the whole size by weight; a source's target stops at `max_repeat` times
   its size, and the excess is shared by weight among the others. Sources are capped in the order
   of cap to weight, so the end state is a prefix sum over sources, without rounds.
2. Blocks: every source is dealt into shards by a seeded hash, about the square root of its rows,
   so a hot source has many. A shard lists its documents in seeded order, and its words are cut
   into blocks of about `block_words` words, equal within one word.
3. Quotas: Sainte-Laguë gives blocks to sources by the highest quotients target / (2k + 1), then
   each source's blocks to its shards, by their blocks. Quotients are made only near the
   outcome: rounded shares are off by at most half a seat each, so a party gains or loses at most
   share * parties / (2 * seats) + 1 seats, and all candidates together are about twice the parties.
4. Selection: a shard with quota q of n blocks takes all of them q div n times, and q mod n more
   from a seeded block on, around the end. A document's share is the overlap of its words with
   these blocks: arithmetic, with no row per block. At most two documents of a shard are cut.

Sources are the entries of a mixing plan, so their number is bounded by it; they are ranked in
one task. All else is partitioned by source and shard.

Defined cases: a null text has size 0; the null source is a source, the last one; sources
without words have target 0; null ids are ids like any other; repeated rows each take part. An
empty table gives no rows. Re-runs agree, as every order is by seeded hashes and then by all columns.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.operators.sizing import fits_broadcast
from martloom.sources.scratch import stored

WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Mix:
    """`weights` are given to the sources in code point order, repeating."""

    weights: tuple[int, ...] = (1, 2, 3)
    max_repeat: int = 3
    block_words: int = 16
    seed: int = 20260101


def size_of(text: Column) -> Column:
    """The number of words of a whole text."""
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))), F.lit(0)).cast("long")


def _ticket(*parts: object) -> Column:
    """A hash, as 32 hex digits, that any engine can repeat; null counts as empty."""
    texts = [F.coalesce(p.cast("string"), F.lit("")) if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.md5(F.concat_ws("|", *texts))


def _dealt_to(ticket: Column, n: Column) -> Column:
    """One of 0 to n - 1, by the ticket's first 60 bits."""
    return F.conv(F.substring(ticket, 1, 15), 16, 10).cast("long") % n


def _targets(totals: DataFrame, mix: Mix) -> DataFrame:
    """(source, source_size, n_docs) -> also sid, weight and target."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weights = F.array(*[F.lit(w) for w in mix.weights])
    parties = (
        totals.withColumn("sid", rank)
        .withColumn("weight", weights[(F.col("sid") - 1) % len(mix.weights)].cast("long"))
        .withColumn("cap", F.col("source_size") * mix.max_repeat)
    )
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "sid")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(0)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    filled = (
        parties.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("weights", F.sum("weight").over(everything))
        .withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("weight_before", F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn(
            "capped",
            F.col("weight") * (F.col("total") - F.col("cap_before")) / (F.col("weights") - F.col("weight_before"))
            > F.col("cap"),
        )
    )
    left = F.col("total") - F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0)).over(everything)
    left_weight = F.sum(F.when(F.col("capped"), 0).otherwise(F.col("weight"))).over(everything)
    return (
        filled.withColumn("left", left)
        .withColumn("left_weight", left_weight)
        .select(
            "sid",
            "source",
            "source_size",
            "n_docs",
            "total",
            F.when(F.col("capped"), F.col("cap").cast("double"))
            .otherwise(F.col("weight") * F.col("left") / F.col("left_weight"))
            .alias("target"),
        )
    )


def apportion(parties: DataFrame, group: str, party: str, share: str, seats: str) -> DataFrame:
    """`parties` with `quota`: the `seats` of each group dealt to its parties by Sainte-Laguë on
    column `share` (not negative). Ties go to the lesser `party`. Shares of zero get nothing."""
    whole = Window.partitionBy(group)
    exact = F.col(share) * F.col(seats) / F.col("_total")
    near = (
        parties.withColumn("_total", F.sum(share).over(whole))
        .withColumn("_parties", F.count(F.lit(1)).over(whole))
        .withColumn("_exact", F.when(F.col("_total") > 0, exact).otherwise(0.0))
        .withColumn("_start", F.floor(F.col("_exact") + 0.5).cast("long"))
        .withColumn("_open", F.when(F.col("_total") > 0, F.col(seats) - F.sum("_start").over(whole)).otherwise(0))
        .withColumn(
            "_most",
            F.ceil(F.col("_exact") * F.col("_parties") / (2 * F.greatest(F.col(seats), F.lit(1)))).cast("long") + 1,
        )
    )
    low = F.when(F.col("_open") > 0, F.col("_start")).otherwise(
        F.greatest(F.col("_start") - F.col("_most"), F.lit(0))
    )
    high = F.when(F.col("_open") > 0, F.col("_start") + F.col("_most")).otherwise(F.col("_start"))
    tried = near.withColumn(
        "_seat",
        F.explode_outer(
            F.when((F.col("_open") != 0) & (F.col(share) > 0) & (low < high), F.sequence(low, high - 1))
        ),
    ).withColumn("_quotient", F.col(share) / (2 * F.col("_seat") + 1))
    best = Window.partitionBy(group).orderBy(F.col("_quotient").desc_nulls_last(), party)
    worst = Window.partitionBy(group).orderBy(F.col("_quotient").asc_nulls_last(), F.col(party).desc())
    ranked = tried.withColumn("_best", F.row_number().over(best)).withColumn(
        "_worst", F.row_number().over(worst)
    )
    change = (
        F.when(F.col("_seat").isNull(), 0)
        .when(F.col("_open") > 0, (F.col("_best") <= F.col("_open")).cast("int"))
        .otherwise(-(F.col("_worst") <= -F.col("_open")).cast("int"))
    )
    columns = [c for c in parties.columns if c not in (group, party)]
    return ranked.groupBy(group, party).agg(
        *[F.first(c).alias(c) for c in columns],
        (F.first("_start") + F.sum(change)).cast("long").alias("quota"),
    )


def _bounded(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if fits_broadcast(df) else df


def mixture(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """One row per row of `docs`: doc_id, row_key (a hash of text and source), source, size,
    source_size, target, taken, `epochs` (times the document is taken whole) and `pieces` (array
    of (first, end) word positions that are taken once more)."""
    rows = stored(
        docs.select(
            "doc_id",
            F.xxhash64("text", "source").alias("row_key"),
            "source",
            size_of(F.col("text")).alias("size"),
            _ticket(mix.seed, F.col("doc_id"), F.col("source"), F.col("text")).alias("ticket"),
        )
    )
    totals = rows.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs")
    )
    sources = stored(_targets(totals, mix))
    dealt = rows.join(
        _bounded(sources.select("sid", F.col("source").alias("_source"), "source_size", "n_docs", "target")),
        F.col("source").eqNullSafe(F.col("_source")),
    ).select(
        "doc_id",
        "row_key",
        "source",
        "size",
        "source_size",
        "target",
        "sid",
        _dealt_to(F.col("ticket"), F.ceil(F.sqrt("n_docs"))).alias("shard"),
        "ticket",
    )
    shards = (
        dealt.groupBy("sid", "shard")
        .agg(F.sum("size").alias("shard_words"))
        .withColumn(
            "blocks",
            F.when(
                F.col("shard_words") > 0,
                F.greatest(F.round(F.col("shard_words") / mix.block_words), F.lit(1)),
            )
            .otherwise(0)
            .cast("long"),
        )
    )
    shards = stored(shards)
    blocks = shards.groupBy("sid").agg(F.sum("blocks").alias("source_blocks"))
    shared = apportion(
        sources.withColumn("all", F.lit(0)).withColumn("seats", F.round(F.col("total") / mix.block_words).cast("long")),
        "all",
        "sid",
        "target",
        "seats",
    )
    of_source = shared.join(blocks, "sid").select(
        "sid", F.least("quota", F.col("source_blocks") * mix.max_repeat).alias("seats")
    )
    quotas = apportion(shards.join(_bounded(of_source), "sid"), "sid", "shard", "blocks", "seats")
    quotas = quotas.select("sid", "shard", "shard_words", "blocks", "quota")

    listed = Window.partitionBy("sid", "shard").orderBy("ticket", "doc_id", "row_key", "size")
    ends = dealt.withColumn(
        "end", F.sum("size").over(listed.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ).withColumn("begin", F.col("end") - F.col("size"))

    n = F.greatest("blocks", F.lit(1))
    rest = F.pmod("quota", n)
    first = _dealt_to(_ticket(mix.seed, F.col("sid"), F.col("shard")), n)

    def words_before(block: Column) -> Column:
        at = F.floor(block * (F.col("shard_words") / n)).cast("long")
        return F.when(block >= n, F.col("shard_words")).otherwise(at)

    ranges = quotas.select(
        "sid",
        "shard",
        F.floor(F.col("quota") / n).cast("long").alias("epochs"),
        words_before(first).alias("from1"),
        words_before(F.least(first + rest, n)).alias("to1"),
        words_before(F.greatest(first + rest - n, F.lit(0))).alias("to2"),
    )
    taken = ends.join(ranges, ["sid", "shard"])
    size = F.col("size")

    def piece(start: Column, end: Column) -> Column:
        return F.struct(
            F.least(F.greatest(start - F.col("begin"), F.lit(0)), size).alias("first"),
            F.least(F.greatest(end - F.col("begin"), F.lit(0)), size).alias("end"),
        )

    pieces = F.filter(
        F.array(piece(F.lit(0), F.col("to2")), piece(F.col("from1"), F.col("to1"))),
        lambda p: p["first"] < p["end"],
    )
    extra = F.aggregate("pieces", F.lit(0).cast("long"), lambda n, p: n + p["end"] - p["first"])
    return taken.withColumn("pieces", pieces).select(
        "doc_id",
        "row_key",
        "source",
        "size",
        "source_size",
        "target",
        (F.col("epochs") * F.col("size") + extra).alias("taken"),
        "epochs",
        "pieces",
    )


def mixed(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The mix itself, with the columns of `docs`: a document taken whole k times stands k times,
    and a piece that is taken once more is a row with the piece's words as they stand in the text
    (and their count in n_chars, where there is such a column). Documents not taken are gone."""
    plan = (
        mixture(docs, mix)
        .where("taken > 0")
        .groupBy(F.col("doc_id").alias("_id"), F.col("row_key").alias("_key"))
        .agg(
            F.sum("epochs").alias("_epochs"),
            F.first("size").alias("_size"),
            F.flatten(F.collect_list("pieces")).alias("_pieces"),
        )
    )
    # The row goes along as one value, so its columns cannot clash with the plan's.
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col("doc_id").alias("id"),
        F.xxhash64("text", "source").alias("key"),
    )
    found = rows.join(
        plan, F.col("id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key"))
    ).dropDuplicates(["_id", "_key"])
    whole = F.struct(F.lit(0).cast("long").alias("first"), F.col("_size").alias("end"))
    parts = F.concat(F.array_repeat(whole, F.col("_epochs").cast("int")), F.col("_pieces"))
    out = found.withColumn("part", F.explode(parts))
    text, first, end = F.col("row.text"), F.col("part.first"), F.col("part.end")
    is_whole = (first == 0) & (end == F.col("_size"))
    # Cut after each word: every piece but the last is white space and one word.
    cut = F.split(text, r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    some = F.array_join(F.slice(cut, (first + 1).cast("int"), (end - first).cast("int")), "")
    some = F.regexp_replace(some, r"^[\x20\x09-\x0D]+", "")
    changed = {"text": some}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length(some).cast(docs.schema["n_chars"].dataType)
    columns = [
        F.when(is_whole, F.col(f"row.`{c}`")).otherwise(changed[c]).alias(c)
        if c in changed
        else F.col(f"row.`{c}`").alias(c)
        for c in docs.columns
    ]
    return out.select(*columns)
