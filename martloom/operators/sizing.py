"""Measured sizes, so that nothing is broadcast on a guess."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

# A broadcast side is held whole by every executor: bounds for one side.
BROADCAST_BYTES = 64 * 1024 * 1024
BROADCAST_ROWS = 1_000_000
# An estimate is no proof that something is small, but reason enough not to measure it.
NOT_WORTH_MEASURING = 32 * BROADCAST_BYTES
UNKNOWN = 2**62
# Upper estimate for a fixed-width value, or the header of one of variable width.
SLOT_BYTES = 16


@dataclass(frozen=True)
class Size:
    rows: int
    bytes: int


def row_width(df: DataFrame) -> Column:
    """Upper estimate of a row's bytes in memory."""
    widths = [F.lit(SLOT_BYTES * (1 + len(df.columns)))]
    for field in df.schema:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (StringType, BinaryType)):
            widths.append(F.coalesce(F.octet_length(c), F.lit(0)))
        elif isinstance(field.dataType, (ArrayType, MapType, StructType)):
            widths.append(F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)) * 4)
    return sum(widths[1:], widths[0]).cast("long")


def measure(df: DataFrame) -> Size:
    """Rows and in-memory bytes, by one aggregate over the whole of `df`."""
    row = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(row_width(df)).alias("bytes")).first()
    return Size(rows=row["rows"], bytes=row["bytes"] or 0)


def worth_measuring(df: DataFrame) -> bool:
    """Whether the optimizer does not think `df` huge."""
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return not NOT_WORTH_MEASURING < estimate < UNKNOWN


def is_small(size: Size) -> bool:
    return size.rows <= BROADCAST_ROWS and size.bytes <= BROADCAST_BYTES


def fits_broadcast(df: DataFrame) -> bool:
    """Whether `df` is measured small enough. What the optimizer thinks huge is not measured."""
    return worth_measuring(df) and is_small(measure(df))
