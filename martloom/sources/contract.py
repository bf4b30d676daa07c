"""Landing-file contracts: which columns a file has, their types and their checks."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import SparkSession
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    TimestampType,
)

from martloom.functions import WHITESPACE_CLASS

LANDING_DECIMAL = DecimalType(15, 2)
TYPES: dict[str, DataType] = {
    "string": StringType(),
    "date": DateType(),
    "decimal": LANDING_DECIMAL,
    "int": IntegerType(),
    "bigint": LongType(),
    "boolean": BooleanType(),
    "timestamp": TimestampType(),
}
_DECIMAL = re.compile(r"decimal\((\d+),\s*(\d+)\)")


def spark_type(name: str) -> DataType | None:
    """The Spark type a contract means, or None."""
    sized = _DECIMAL.fullmatch(name)
    return DecimalType(int(sized[1]), int(sized[2])) if sized else TYPES.get(name)


DEFAULT_DATE_FORMAT = "YYYY-MM-DD"
# Flag column of a scan that looks for rows with too few or too many fields.
MALFORMED = "_malformed"
# Name columns every landing file has standardised before its rows are checked.
DEFAULT_STANDARDIZED = ("first_name", "last_name")


@dataclass(frozen=True)
class ContractColumn:
    name: str
    type: str = "string"
    nullable: bool = True
    format: str = DEFAULT_DATE_FORMAT
    pii: bool = False

    @property
    def spark_type(self) -> DataType:
        return spark_type(self.type)

    @property
    def date_pattern(self) -> str:
        """The contract's format in Spark's pattern letters."""
        return self.format.replace("Y", "y").replace("D", "d")

    @property
    def date_shape(self) -> str:
        """A regular expression for the shape of the format: digits in their places."""
        parts = re.findall(r"[YMD]+|[^YMD]+", self.format)
        body = "".join(
            rf"\d{{{len(p)}}}" if p[0] in "YMD" else re.escape(p) for p in parts
        )
        return body


@dataclass(frozen=True)
class Contract:
    org: str
    file_type: str
    columns: tuple[ContractColumn, ...]
    not_null: tuple[str, ...] = ()
    delimiter: str = ","
    id_field: str | None = None
    match_fallback: tuple[str, ...] = ()
    org_field: str = "org_code"
    standardized: tuple[str, ...] = DEFAULT_STANDARDIZED
    # Characters that count as blank, as in a character class. " " is a spaces-only trim.
    blank: str = WHITESPACE_CLASS

    def __post_init__(self) -> None:
        unknown = sorted({c.type for c in self.columns if spark_type(c.type) is None})
        if unknown:
            raise ValueError(f"{self.file_type}: unknown column types {unknown}")
        undeclared = sorted(set(self.not_null) - set(self.names))
        if undeclared:
            raise ValueError(f"{self.file_type}: not-null checks on undeclared columns {undeclared}")

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def of_type(self, type_name: str) -> list[ContractColumn]:
        return [c for c in self.columns if c.type.partition("(")[0] == type_name]

    def typed(self) -> list[ContractColumn]:
        """Columns whose text must be read as something else, dates first."""
        return sorted(
            (c for c in self.columns if c.type != "string"), key=lambda c: c.type != "date"
        )

    def for_org(self, org: str) -> Contract:
        return replace(self, org=org)


def parse_contract(doc: Mapping) -> Contract:
    """A contract from its JSON document."""
    pii = set(doc.get("pii_fields", ()))
    return Contract(
        org=doc["org"],
        file_type=doc["file_type"],
        delimiter=doc.get("delimiter", ","),
        columns=tuple(
            ContractColumn(
                name=c["name"],
                type=c.get("type", "string"),
                nullable=c.get("nullable", True),
                format=c.get("format", DEFAULT_DATE_FORMAT),
                pii=c.get("pii", False) or c["name"] in pii,
            )
            for c in doc["columns"]
        ),
        not_null=tuple(doc.get("not_null_check", ())),
        id_field=doc.get("ssn_field"),
        match_fallback=tuple(doc.get("match_fallback", ())),
    )


def load_contract(spark: SparkSession, path: str) -> Contract:
    """Read one contract document from any file system Spark can reach."""
    row = spark.read.text(path, wholetext=True).first()
    if row is None:
        raise ValueError(f"empty contract: {path}")
    return parse_contract(json.loads(row.value))
