"""Appending only what a fact table does not hold yet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql.types import DateType, DecimalType, IntegralType, StringType

from martloom.operators.dedup import first_per_key
from martloom.operators.sizing import fits_broadcast

# Types whose literals compare in every session as values in files do.
_ORDERED_ALIKE = (DateType, DecimalType, IntegralType, StringType)


def new_facts(
    batch: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    *,
    one_per_key: bool = False,
    broadcast_keys: bool | None = None,
) -> DataFrame:
    """Distinct batch rows whose key the target does not hold.

    Rows of one batch that share a key but differ are all kept, unless `one_per_key`. The
    target is read once, on its key columns only, and only where its first key lies between the batch's
    least and greatest, which the scan can tell from its files' statistics. If the batch's keys
    are measured small (a narrow pass over the key columns) they are broadcast, and the target is not
    shuffled; otherwise both meet in one anti join, whose left side the engine splits where a
    key is hot. Rows already held go before duplicates are looked for, so a batch that is
    repeated shuffles next to nothing.
    `broadcast_keys=False` asks for a shuffled join whatever the engine thinks of the sizes.
    """
    keys = list(keys)
    held = _within(target.select(*keys), batch, keys[0])
    if broadcast_keys is False:
        held = held.hint("merge")
    elif broadcast_keys is None:
        # All rows bound the distinct ones, and need no shuffle to be measured.
        broadcast_keys = fits_broadcast(batch.select(*keys))
    if broadcast_keys:
        # At most the batch's own keys, hence within the same bound.
        met = held.join(F.broadcast(batch.select(*keys)), keys, "left_semi").distinct()
        held = F.broadcast(met)
    new = batch.join(held, keys, "left_anti").select(*batch.columns)
    return first_per_key(new, keys) if one_per_key else new.distinct()


def _within(held: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Rows between the batch's least and greatest key, as literals, so that the scan skips the rest."""
    if not isinstance(batch.schema[key].dataType, _ORDERED_ALIKE):
        return held
    least, greatest = batch.agg(F.min(key), F.max(key)).first()
    if least is None:
        return held.limit(0)
    kind = batch.schema[key].dataType
    return held.where(F.col(key).between(F.lit(least).cast(kind), F.lit(greatest).cast(kind)))
