"""Column contracts: driver-side schema checks and conforming rows to a target."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_TYPES: dict[str, DataType] = {
    "BIGINT": LongType(),
    "BOOLEAN": BooleanType(),
    "DATE": DateType(),
    "DECIMAL(12,2)": DecimalType(12, 2),
    "INT": IntegerType(),
    "STRING": StringType(),
    "TIMESTAMP": TimestampType(),
}


def columns(**types: str) -> StructType:
    """A schema from `name="TYPE"` or `name="TYPE NOT NULL"`; needs no session, unlike DDL text."""
    fields = []
    for name, text in types.items():
        type_name = text.removesuffix(" NOT NULL")
        fields.append(StructField(name, _TYPES[type_name], nullable=type_name == text))
    return StructType(fields)


class MissingColumns(ValueError):
    """A required column is absent."""


def require_columns(actual: Iterable[str], required: Sequence[str]) -> None:
    present = set(actual)
    missing = [name for name in required if name not in present]
    if missing:
        raise MissingColumns(f"missing required columns: {missing}")


@dataclass(frozen=True)
class SchemaDiff:
    missing: tuple[str, ...]
    unexpected: tuple[str, ...]
    retyped: tuple[str, ...]

    def __bool__(self) -> bool:
        return bool(self.missing or self.unexpected or self.retyped)

    def __str__(self) -> str:
        parts = (("missing", self.missing), ("unexpected", self.unexpected), ("retyped", self.retyped))
        return "; ".join(f"{label}: {', '.join(names)}" for label, names in parts if names)


def schema_diff(actual: StructType, target: StructType) -> SchemaDiff:
    """How `actual` departs from `target`, by name; needs no job."""
    have = {f.name: f.dataType for f in actual}
    want = {f.name: f.dataType for f in target}
    return SchemaDiff(
        missing=tuple(n for n in want if n not in have),
        unexpected=tuple(n for n in have if n not in want),
        retyped=tuple(n for n in want if n in have and have[n] != want[n]),
    )


def conform(
    df: DataFrame, target: StructType, defaults: Mapping[str, Column] | None = None
) -> DataFrame:
    """Exactly the target's columns, in its order, matched by name and cast to its types.

    Absent columns, and NULLs in present ones, take their default if there is one;
    an absent column without a default must be nullable. A value too big for the
    target's type, or a NULL in a NOT NULL column, fails the job when it runs.
    """
    defaults = defaults or {}
    have = set(df.columns)
    require_columns(
        have | defaults.keys(), [f.name for f in target if not f.nullable]
    )
    columns = []
    for field in target:
        value = F.col(f"`{field.name}`") if field.name in have else F.lit(None)
        if field.name in defaults:
            value = F.coalesce(value, defaults[field.name])
        if field.name not in have:
            value = value.cast(field.dataType)
        elif df.schema[field.name].dataType != field.dataType:
            # Spelled out, as a plain cast loses what does not fit where ANSI mode is off.
            fitted = value.try_cast(field.dataType)
            misfit = F.raise_error(F.lit(f"value does not fit {field.name}")).cast(field.dataType)
            value = F.when(value.isNotNull() & fitted.isNull(), misfit).otherwise(fitted)
        if not field.nullable:
            value = F.coalesce(
                value, F.raise_error(F.lit(f"NULL in {field.name}")).cast(field.dataType)
            )
        columns.append(value.alias(field.name))
    return df.select(*columns)
