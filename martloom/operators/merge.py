"""Slowly changing dimensions: keyed merges of a batch into a dimension.

Two plans give the same rows. A batch measured small enough is broadcast, and the
dimension is never shuffled; any other batch meets the dimension in one full outer
join, which shuffles both sides once on the keys. Rows whose key holds a NULL match
nothing, as in SQL MERGE.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.operators.dedup import first_per_key, measured_unique, require_unique
from martloom.operators.sizing import fits_broadcast

_OLD = "_old_"
_NEW = "_new_"
_HAS_OLD = "_has_old"
_HAS_NEW = "_has_new"
_VERSION = "_version"


@dataclass(frozen=True)
class Scd1:
    """Overwrite in place: one row per key."""

    keys: tuple[str, ...]
    attributes: tuple[str, ...]
    current: str | None = "is_current"
    created: str = "created_date"
    updated: str = "updated_date"


@dataclass(frozen=True)
class Scd2:
    """Keep history: one row per version. A difference in `tracked` starts a new version."""

    keys: tuple[str, ...]
    tracked: tuple[str, ...]
    current: str = "is_current"
    start: str = "effective_date"
    end: str = "end_date"
    created: str = "created_date"
    updated: str = "updated_date"


def _prefixed(df: DataFrame, prefix: str, marker: str) -> DataFrame:
    columns = [F.col(f"`{c}`").alias(prefix + c) for c in df.columns]
    return df.select(*columns, F.lit(True).alias(marker))


def _on(keys: Sequence[str]) -> Column:
    return reduce(and_, [F.col(_OLD + k) == F.col(_NEW + k) for k in keys])


def _pair(
    target: DataFrame, source: DataFrame, keys: Sequence[str], broadcast_source: bool
) -> DataFrame:
    """Target and source rows side by side; unmatched rows have the other side NULL."""
    old = _prefixed(target, _OLD, _HAS_OLD)
    new = _prefixed(source, _NEW, _HAS_NEW)
    if not broadcast_source:
        return old.join(new, _on(keys), "full_outer")

    # Keys met in the target are at most those of the source, so they may be broadcast too.
    source_keys = new.select(*[_NEW + k for k in keys])
    target_keys = old.select(*[_OLD + k for k in keys])
    met = target_keys.join(F.broadcast(source_keys), _on(keys), "left_semi").distinct()
    matched = old.join(F.broadcast(new), _on(keys), "left")
    unmet = new.join(F.broadcast(met), _on(keys), "left_anti")
    return matched.unionByName(unmet, allowMissingColumns=True)


def changed(tracked: Sequence[str], *, null_safe: bool = True) -> Column:
    """Whether a matched pair differs. Without `null_safe`, NULL against a value is no change."""
    old = [F.col(_OLD + c) for c in tracked]
    new = [F.col(_NEW + c) for c in tracked]
    if null_safe:
        differs = [~o.eqNullSafe(n) for o, n in zip(old, new)]
    else:
        differs = [F.coalesce(o != n, F.lit(False)) for o, n in zip(old, new)]
    return reduce(or_, differs)


def scd2_step(
    current: DataFrame,
    source: DataFrame,
    spec: Scd2,
    batch_date: date,
    load_date: date,
    *,
    expire_only: bool = False,
    null_safe: bool = True,
    broadcast_source: bool | None = None,
) -> DataFrame:
    """Current versions after the batch, and the versions the batch closed.

    `source` has one row per key. With `expire_only` a changed key is closed and its new
    version waits for the next run of the batch. `broadcast_source` None measures the source.
    """
    if broadcast_source is None:
        broadcast_source = fits_broadcast(source)
    pairs = _pair(current, source, spec.keys, broadcast_source)

    has_old, has_new = F.col(_HAS_OLD).isNotNull(), F.col(_HAS_NEW).isNotNull()
    closes = has_old & has_new & changed(spec.tracked, null_safe=null_safe)
    old, new = F.array(F.lit("old")), F.array(F.lit("new"))
    both = old if expire_only else F.array(F.lit("old"), F.lit("new"))
    versions = (
        pairs.withColumn("_closes", closes)
        .withColumn(
            _VERSION,
            F.explode(F.when(F.col("_closes"), both).when(has_old, old).otherwise(new)),
        )
    )

    is_old = F.col(_VERSION) == "old"
    closes_now = F.col("_closes")
    kept = {c: F.col(_OLD + c) for c in current.columns}
    kept[spec.current] = kept[spec.current] & ~closes_now
    kept[spec.end] = F.when(closes_now, F.lit(batch_date - timedelta(days=1))).otherwise(kept[spec.end])
    kept[spec.updated] = F.when(closes_now, F.lit(load_date)).otherwise(kept[spec.updated])

    fresh = {c: F.col(_NEW + c) for c in source.columns}
    fresh |= {
        spec.current: F.lit(True),
        spec.start: F.lit(batch_date),
        spec.end: F.lit(None),
        spec.created: F.lit(load_date),
        spec.updated: F.lit(load_date),
    }
    return versions.select(
        *[
            F.when(is_old, kept[f.name])
            .otherwise(fresh.get(f.name, F.lit(None)).cast(f.dataType))
            .alias(f.name)
            for f in current.schema
        ]
    )


def scd2_merge(
    target: DataFrame,
    source: DataFrame,
    spec: Scd2,
    batch_date: date,
    load_date: date,
    **options: bool | None,
) -> DataFrame:
    """The whole dimension after the batch. Closed versions bypass the join."""
    is_current = F.col(spec.current)
    step = scd2_step(target.where(is_current), source, spec, batch_date, load_date, **options)
    return step.unionByName(target.where(~is_current | is_current.isNull()))


def scd1_upsert(
    target: DataFrame,
    source: DataFrame,
    spec: Scd1,
    load_date: date,
    *,
    order: Sequence[Column] | None = None,
    broadcast_source: bool | None = None,
) -> DataFrame:
    """Target rows updated from the source, plus source rows with new keys.

    Every matched row is updated, changed or not. With `order`, the source is first cut to
    one row per key; without it, duplicate source keys are an error.
    """
    source = source.select(*spec.keys, *spec.attributes)
    if order is not None:
        source = first_per_key(source, spec.keys, order)
    elif broadcast_source is None:
        broadcast_source = measured_unique(source, spec.keys)
    else:
        source = require_unique(source, spec.keys)
    if broadcast_source is None:
        broadcast_source = fits_broadcast(source)
    pairs = _pair(target, source, spec.keys, broadcast_source)

    has_old, has_new = F.col(_HAS_OLD).isNotNull(), F.col(_HAS_NEW).isNotNull()
    today = F.lit(load_date)
    values = {c: F.col(_OLD + c) for c in target.columns}
    for name in (*spec.keys, *spec.attributes):
        values[name] = F.when(has_new, F.col(_NEW + name)).otherwise(values[name])
    values[spec.created] = F.when(has_old, values[spec.created]).otherwise(today)
    values[spec.updated] = F.when(has_new, today).otherwise(values[spec.updated])
    if spec.current is not None:
        values[spec.current] = F.when(has_old, values[spec.current]).otherwise(F.lit(True))
    return pairs.select(
        *[values[f.name].cast(f.dataType).alias(f.name) for f in target.schema]
    )
