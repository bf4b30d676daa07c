"""Benchmark decontamination by spaced seeds.

Words of every text are hashed, and a few fixed masks are laid over every position. A mask names
the words it looks at and ignores those between, so a hit survives substitutions at the ignored
places. The masks together hit every passage that the rule below admits: from eight words on the
first three do, for six and seven words it takes all of them, items of five words have masks of
their own, and shorter ones, of which the rule admits no other word, are one seed each. Other rules
are accepted only where enumeration shows that their masks miss nothing they admit.
Seeds of the items meet the seeds of the documents in one join. Around each hit item and document
are laid over each other on the hit's diagonal, and compared word by word: the document holds the
item if some window of `window` words of the item (or all of a shorter item) has at least
`similarity` of its words equal in place.

The whole main path is one stage over the documents: words, seeds, join and check stay within
generated code, and only found pairs are shuffled. The items are the query set. Seeds of at most
`SEEDS_PER_PASS` words' worth are broadcast at once; a larger set is dealt into blocks, each of
which passes over the documents' hashed words.

Defined cases: a null or empty text has no words, holds nothing and is held by nothing; an item of
one word is held by every document with that word; null ids are ids like any other
(pairs of a null id are one pair); a document is known by its id and a hash of its whole text, so
texts that share an id are compared and removed apart, and only the report puts them together, with
their best overlap; repeated rows count as one document or item; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.sources.scratch import stored

# Lower-cased words: digits, ASCII letters and everything beyond ASCII.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# 1: the word counts, 0: it is ignored.
MASKS_OF_LONG = ("110111", "1101011", "11100101")
# With these, also windows of six and seven words are hit wherever a word is replaced.
MASKS_OF_SHORT = ("11111", "101111", "111011", "111101")
MASKS = MASKS_OF_LONG + MASKS_OF_SHORT
# Windows of so many words and more do without MASKS_OF_SHORT.
LONG = 8
# Items of five words: any four of them in place.
MASKS_OF_FIVE = ("1111", "11011", "10111", "11101")
# Items of up to so many words are one seed.
EXACT = 4
# Words of the items whose seeds one pass broadcasts: about 24 bytes for each word and mask,
# and 8 for the item's own words, so some 40 MB.
SEEDS_PER_PASS = 400_000


@dataclass(frozen=True)
class Overlap:
    window: int = 13
    similarity: float = 0.8
    masks: tuple[str, ...] = MASKS

    def __post_init__(self) -> None:
        """Windows of every length are hit, whichever words the rule lets differ."""
        for n in range(1, self.window + 1):
            missed = missed_pattern(n, self)
            if missed is not None:
                raise ValueError(
                    f"{self.similarity} of {n} words lets the words {missed} differ, which no mask survives"
                )


def missed_pattern(n_words: int, how: Overlap) -> tuple[int, ...] | None:
    """Places of as many other words as the rule admits in a window of `n_words`, by which all
    masks are missed; None if there are none."""
    equal = next(k for k in range(n_words + 1) if k / n_words >= how.similarity)
    if not equal:
        return tuple(range(n_words))
    laid = {
        frozenset(at + i for i, bit in enumerate(mask) if bit == "1")
        for mask in masks_of(n_words, how)
        for at in range(n_words - len(mask) + 1)
    }
    # Fewer other words are a part of some pattern of the most.
    for places in combinations(range(n_words), n_words - equal):
        if not any(seed.isdisjoint(places) for seed in laid):
            return places
    return None


def masks_of(n_words: int, how: Overlap) -> tuple[str, ...]:
    """The masks that hit an item of `n_words` words wherever `how` admits other words."""
    if n_words <= EXACT:
        return ("1" * n_words,) if n_words else ()
    if n_words == 5:
        return MASKS_OF_FIVE
    if min(n_words, how.window) < LONG:
        return how.masks
    return tuple(m for m in how.masks if m not in MASKS_OF_SHORT)


def word_hashes(text: Column) -> Column:
    """Hashes of the words of a whole text; null counts as empty."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), NOT_WORD)
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def _rotated(word: Column, by: int) -> Column:
    return F.shiftleft(word, by).bitwiseOR(F.shiftrightunsigned(word, 64 - by))


def _seeds(texts: DataFrame, hashes: str, position: str, masks: tuple[str, ...]) -> DataFrame:
    """One row per position and mask, with its `seed`: the words a mask picks, each turned by its
    place, and the mask as a number. Plain bit operations keep the generated code small enough to
    be compiled, which hash functions of many arguments do not."""
    span = min(len(m) for m in masks)
    at = texts.withColumn(
        position,
        F.explode(
            F.when(F.size(hashes) >= span, F.sequence(F.lit(0), F.size(hashes) - span))
        ),
    )
    used = sorted({i for m in masks for i, bit in enumerate(m) if bit == "1"})
    at = at.select("*", *[F.get(hashes, F.col(position) + i).alias(f"_w{i}") for i in used])
    seeds = []
    for mask in masks:
        seed = F.lit(int(f"1{mask}", 2)).cast("long")
        for place, i in enumerate(i for i, bit in enumerate(mask) if bit == "1"):
            seed = seed.bitwiseXOR(_rotated(F.col(f"_w{i}"), 11 * place + 1))
        seeds.append(seed)  # null where the mask reaches beyond the end
    kept = [c for c in at.columns if not c.startswith("_w")]
    return at.select(*kept, F.explode(F.array(*seeds)).alias("seed")).where("seed IS NOT NULL")


def _best_window(equal: Column, width: Column) -> Column:
    """The most equal words in `width` words on end."""
    return F.array_max(
        F.transform(
            F.sequence(F.lit(1), F.size(equal) - width + 1),
            lambda i: F.aggregate(F.slice(equal, i, width), F.lit(0), lambda n, x: n + x),
        )
    )


def _block_matches(
    hashed: DataFrame, items: DataFrame, lengths: dict[tuple[str, ...], list[int]], how: Overlap
) -> DataFrame:
    """Verified (doc_id, row_key, item_id, first_word, ...) of one block of items; `lengths` are
    the items' numbers of words, by the masks that these take, the last one standing for more."""
    item_n = F.size("item_words")
    seeds = None
    for masks, ns in lengths.items():
        own = items.where(F.least(item_n, F.lit(LONG)).isin(ns))
        own = _seeds(own, "item_words", "item_at", masks).select(
            "seed", "item_key", "item_at", item_n.alias("item_n")
        )
        seeds = own if seeds is None else seeds.unionByName(own)
    used = tuple(sorted({m for masks in lengths for m in masks}))
    diagonal = F.col("at") - F.col("item_at")
    # A passage is hit many times on its diagonal: it is compared once.
    hits = (
        _seeds(hashed, "words", "at", used)
        .join(F.broadcast(seeds), "seed")
        .select(
            "doc_id",
            "row_key",
            "item_key",
            diagonal.alias("diagonal"),
            F.slice("words", F.greatest(diagonal, F.lit(0)) + 1, F.col("item_n")).alias("d"),
        )
        .groupBy("doc_id", "row_key", "item_key", "diagonal")
        .agg(F.first("d").alias("d"))
    )
    laid = hits.join(F.broadcast(items), "item_key").select(
        "doc_id",
        "row_key",
        "item_id",
        "diagonal",
        F.size("item_words").alias("item_words_n"),
        "d",
        F.slice("item_words", F.greatest(-F.col("diagonal"), F.lit(0)) + 1, F.size("item_words")).alias("i"),
    )
    shared = F.least(F.size("d"), F.size("i"))
    equal = F.transform(
        F.sequence(F.lit(0), shared - 1),
        lambda j: (F.get("d", j) == F.get("i", j)).cast("int"),
    )
    width = F.least(F.col("item_words_n"), F.lit(how.window))
    return (
        laid.where(shared >= width)
        .withColumn("equal", equal)
        .withColumn("best", _best_window(F.col("equal"), width) / width)
        .where(F.col("best") >= how.similarity)
        .select(
            "doc_id",
            "row_key",
            "item_id",
            F.greatest("diagonal", F.lit(0)).cast("long").alias("first_word"),
            F.aggregate("equal", F.lit(0), lambda n, x: n + x).cast("long").alias("n_equal"),
            F.col("item_words_n").cast("long").alias("n_item_words"),
            "best",
        )
    )


def _matches(docs: DataFrame, items: DataFrame, how: Overlap) -> DataFrame:
    """Verified (doc_id, row_key, item_id, first_word, ...) of all items; `row_key` is a hash of
    the document's whole text."""
    hashed = docs.select(
        "doc_id", F.xxhash64("text").alias("row_key"), word_hashes(F.col("text")).alias("words")
    )
    prepared = items.select("item_id", word_hashes(F.col("text")).alias("item_words")).distinct()
    prepared = stored(prepared.withColumn("item_key", F.xxhash64("item_id", "item_words")))
    by_length = prepared.groupBy(F.least(F.size("item_words"), F.lit(LONG)).alias("n"))
    by_length = by_length.agg(F.sum(F.size("item_words")).alias("n_words")).collect()
    n_words = sum(r["n_words"] for r in by_length)
    lengths: dict[tuple[str, ...], list[int]] = {}
    for n in sorted(r["n"] for r in by_length):
        if masks := masks_of(n, how):
            lengths.setdefault(masks, []).append(n)
    lengths = lengths or {masks_of(LONG, how): [LONG]}  # no item has words
    n_blocks = -(-n_words // SEEDS_PER_PASS)
    if n_blocks > 1:
        hashed = stored(hashed)
    found = None
    for block in range(max(n_blocks, 1)):
        part = prepared
        if n_blocks > 1:
            part = prepared.where(F.pmod("item_key", F.lit(n_blocks)) == block)
        matches = _block_matches(hashed, part, lengths, how)
        found = matches if found is None else found.unionByName(matches)
    return found


def leaks(docs: DataFrame, items: DataFrame, how: Overlap = Overlap()) -> DataFrame:
    """(doc_id, item_id, first_word, n_equal, n_item_words, best_window) of every document that
    holds a passage of an item; of several places the one with the most equal words."""
    return (
        _matches(docs, items, how)
        .groupBy("doc_id", "item_id")
        .agg(
            F.max(
                F.struct("n_equal", "best", (-F.col("first_word")).alias("back"), "n_item_words")
            ).alias("top")
        )
        .select(
            "doc_id",
            "item_id",
            (-F.col("top.back")).alias("first_word"),
            F.col("top.n_equal").alias("n_equal"),
            F.col("top.n_item_words").alias("n_item_words"),
            F.col("top.best").alias("best_window"),
        )
    )


def decontaminated(docs: DataFrame, items: DataFrame, how: Overlap = Overlap()) -> DataFrame:
    """The rows of `docs` that hold no passage of an item, with all their columns."""
    held = _matches(docs, items, how)
    held = held.select(F.col("doc_id").alias("_held"), F.col("row_key").alias("_key")).distinct()
    return docs.join(
        held,
        docs["doc_id"].eqNullSafe(held["_held"]) & (F.xxhash64(docs["text"]) == held["_key"]),
        "left_anti",
    )
