"""One row per key, chosen deterministically, and the gates that ask for it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

from martloom.operators.sizing import Size, is_small, row_width, worth_measuring

_RANK = "_rank"


class DuplicateKeys(ValueError):
    """A merge source holds more than one row for a key."""


def tie_breakers(df: DataFrame, used: Sequence[str]) -> list[Column]:
    """Every other sortable column: ties are then between rows that are equal."""
    return [
        F.col(f"`{f.name}`").desc_nulls_last()
        for f in df.schema
        if f.name not in used and not isinstance(f.dataType, (MapType, VariantType))
    ]


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """The first row of each key in `order`; NULL keys form groups of their own.

    Spark keeps one row per key in every map task before the shuffle (window group
    limit), so a hot key sends at most one row per task.
    """
    return _first(df, keys, [*order, *tie_breakers(df, keys)])


def latest_per_key(df: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """The row of each key with the greatest `by`, NULL being the least."""
    order = [F.col(c).desc_nulls_last() for c in by]
    return _first(df, keys, [*order, *tie_breakers(df, [*keys, *by])])


def _first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*(order or [F.lit(0)]))
    ranked = df.withColumn(_RANK, F.row_number().over(window))
    return ranked.where(F.col(_RANK) == 1).drop(_RANK)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one row, and how many; counted before the shuffle."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.where(F.col("n_rows") > 1)


def _refuse(keys: Sequence[str], shown: Sequence[tuple]) -> None:
    raise DuplicateKeys(f"more than one source row for {tuple(keys)}, such as {list(shown)}")


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`df` itself, or DuplicateKeys with a few of the offenders. Runs a job on the keys only."""
    offenders = duplicate_keys(df.select(*keys), keys).limit(5).collect()
    if offenders:
        _refuse(keys, [tuple(row[k] for k in keys) for row in offenders])
    return df


def measured_unique(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether `df` is measured small enough to be broadcast, or DuplicateKeys with one offender:
    one job where the gate and the measure would each compute `df`. Rows are counted and their
    bytes added up before the shuffle, so only keys travel."""
    if not worth_measuring(df):
        require_unique(df, keys)
        return False
    per_key = df.groupBy(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)]).agg(
        F.count(F.lit(1)).alias("_rows"), F.sum(row_width(df)).alias("_bytes")
    )
    key = F.struct(*[f"_k{i}" for i in range(len(keys))])
    found = per_key.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("_bytes"), F.lit(0)).alias("bytes"),
        F.coalesce(F.max("_rows"), F.lit(0)).alias("most"),
        F.max_by(key, "_rows").alias("key"),
    ).first()
    if found["most"] > 1:
        _refuse(keys, [tuple(found["key"])])
    return is_small(Size(rows=found["rows"], bytes=found["bytes"]))
