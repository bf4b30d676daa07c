"""Joins that keep hot keys out of the shuffle.

AQE splits a skewed partition only where no later operator relies on how the join is
partitioned. These joins do not depend on that: the few keys with the most rows are joined
by broadcast, the others as usual. Which keys count as hot changes the plan, not the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from martloom.operators.sizing import fits_broadcast

# A key with this many rows is more than one task should have to join. There are at most as
# many such keys as there are times as many rows, so they can be gathered.
HOT_ROWS = 5_000_000


def hottest_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """The keys with at least `hot_rows` rows, or None. One job on the keys, counted map-side."""
    counts = df.select(*keys).na.drop().groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = counts.where(F.col("_n") >= hot_rows)
    found = [tuple(row[k] for k in keys) for row in hot.collect()]
    if not found:
        return None
    schema = StructType([StructField(k, df.schema[k].dataType) for k in keys])
    return df.sparkSession.createDataFrame(found, schema)


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    *,
    broadcast_right: bool | None = None,
    hot_rows: int = HOT_ROWS,
    counted_in: DataFrame | None = None,
) -> DataFrame:
    """Inner join of many rows with a table that has about one row per key.

    Keys are counted in `left`, or in `counted_in`: where `left` is itself a join, the rows it was
    made from have the same hot keys, and are counted without joining them once more.

    With `broadcast_right=False` the table as a whole is never broadcast, whatever the engine
    thinks of its size; only its rows for hot keys are, where they are measured small.
    """
    keys = list(keys)
    asked = broadcast_right is False
    if broadcast_right is None:
        broadcast_right = fits_broadcast(right)
    if broadcast_right:
        return left.join(F.broadcast(right), keys)

    hot = hottest_keys(left if counted_in is None else counted_in, keys, hot_rows)
    rest = right.hint("merge") if asked else right
    if hot is None:
        return left.join(rest, keys)
    hot_right = right.join(F.broadcast(hot), keys, "left_semi")
    if not fits_broadcast(hot_right):
        return left.join(rest, keys)
    hot_left = left.join(F.broadcast(hot), keys, "left_semi")
    cold_left = left.join(F.broadcast(hot), keys, "left_anti")
    return hot_left.join(F.broadcast(hot_right), keys).unionByName(cold_left.join(rest, keys))
