"""Landing columns to table columns: casts, renames, constants, audit columns."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from martloom.sources.contract import DEFAULT_DATE_FORMAT, Contract, ContractColumn


def parse_value(column: ContractColumn, data_type: DataType | None = None) -> Column:
    """A text column read as its contract type, or `data_type`; NULL where that is impossible."""
    c = F.col(column.name)
    if column.type == "date":
        parsed = F.try_to_date(c, column.date_pattern)
        if column.format != DEFAULT_DATE_FORMAT:
            return parsed
        # A text that is how its date is written reads alike both ways, and a cast needs no formatter.
        plain = c.try_cast("date")
        written = (F.octet_length(c) == 10) & (plain.cast("string") == c)
        return F.when(written, plain).otherwise(parsed)
    return c.try_cast(data_type or column.spark_type)


def typed_cast(df: DataFrame, contract: Contract) -> DataFrame:
    """Every contract column of `df` in its contract type."""
    have = set(df.columns)
    return df.withColumns({c.name: parse_value(c) for c in contract.typed() if c.name in have})


@dataclass(frozen=True)
class ColumnMapping:
    """Table columns made from landing columns.

    `derived` values are functions, as columns can only be built with a session running.
    """

    renamed: Mapping[str, str] = field(default_factory=dict)
    derived: Mapping[str, Callable[[], Column]] = field(default_factory=dict)
    dropped: tuple[str, ...] = ()


def map_columns(df: DataFrame, mapping: ColumnMapping) -> DataFrame:
    """Derive, then rename, then drop."""
    derived = df.withColumns({name: make() for name, make in mapping.derived.items()})
    return derived.drop(*mapping.dropped).withColumnsRenamed(dict(mapping.renamed))


def timestamp(moment: datetime) -> Column:
    """A timestamp literal; a moment without a zone is in the session's zone."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp")


def add_audit(df: DataFrame, batch_date: date, load_timestamp: datetime) -> DataFrame:
    """Both values are given, never taken from the clock, so a re-run repeats itself."""
    return df.withColumns(
        {"batch_date": F.lit(batch_date), "load_timestamp": timestamp(load_timestamp)}
    )
