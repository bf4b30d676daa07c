"""Which parts of a table may hold a batch's keys, told by bitmaps and without reading the parts.

A part (one folder of facts, say) has a sketch: a set of slots as Spark's own bitmaps, one row per run
of slots that has any. A key always falls in the same slot, so two sketches without a slot in common have no
key in common; the other way round a part may be opened in vain, but none is missed.

With `dense` keys, one integer that counts things up, the slot is the key itself: sketches are exact, and of
a fraction of the keys' size. Other keys are hashed to SLOTS slots, at most four megabytes a part; that
tells parts apart while a batch's keys times the share of slots a part uses stay small, so it pays for
small or repeated batches, and costs little for others.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

SLOTS = 1 << 25
_INTEGRAL = (ByteType, ShortType, IntegerType, LongType)


def _slot(df: DataFrame, keys: Sequence[str], dense: bool) -> Column:
    if not dense:
        return F.pmod(F.xxhash64(*keys), F.lit(SLOTS))
    if len(keys) != 1 or not isinstance(df.schema[keys[0]].dataType, _INTEGRAL):
        raise ValueError(f"dense keys are one integer, not {list(keys)}")
    return F.col(keys[0]).cast("long")


def key_sketch(df: DataFrame, keys: Sequence[str], *, dense: bool = False) -> DataFrame:
    """(run, slots): the slots of the keys, a bitmap for each run of them. Keys with NULL equal none."""
    slots = df.select(*keys).na.drop().select(_slot(df, keys, dense).alias("slot"))
    return slots.groupBy(F.bitmap_bucket_number("slot").alias("run")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("slots")
    )


def sketches_of(parts: Mapping[str, DataFrame]) -> DataFrame:
    """(part, run, slots) of the sketches of named parts."""
    named = [sketch.select(F.lit(name).alias("part"), "run", "slots") for name, sketch in parts.items()]
    return reduce(DataFrame.unionByName, named)


def parts_that_may_hold(sketches: DataFrame, batch: DataFrame) -> list[str]:
    """Names of the parts (part, run, slots) that may hold a key of the batch's sketch (run, slots).

    Bitmaps of runs that both have meet in the shuffle of one aggregate; names alone are collected.
    """
    met = sketches.join(batch.select("run", F.col("slots").alias("wanted")), "run")
    both = met.select("part", "run", F.explode(F.array("slots", "wanted")).alias("slots"))
    common = both.groupBy("part", "run").agg(F.bitmap_and_agg("slots").alias("slots"))
    found = common.where(F.bitmap_count("slots") > 0).select("part").distinct()
    return sorted(row["part"] for row in found.collect())
