"""Tables whose schema grows: a log of schemas beside the files, appends that may be repeated.

Beside its rows a table holds `_schema/<version>.json`, one file per schema it has had, written
before any row of that version and never changed. Rows lie in
`schema_version=<version>/append=<token>`, one folder per append, in the schema of their version.

A schema may gain columns, and columns may be widened to a type that holds every old value;
anything else is refused before a row is written. Old files are not touched: a read takes each
version's files by the version's own schema, by column name, and brings them to the wanted version.
Columns the files lack are filled with the default given when the column was added, else NULL.
The versions' scans meet in one union, through which filters and column pruning reach each of them.

An append is known by its token. Repeating it replaces what it wrote, under whatever version it did,
so that a job may be run again. Two writers that extend the schema at once both look at the
log again until their version is the next one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StructField,
    StructType,
)

from martloom.operators.schema import conform
from martloom.sources.tables import (
    as_nullable,
    child_folders,
    drop_folder,
    escaped,
    numbered_texts,
    write_new,
)

VERSION, TOKEN = "schema_version", "append"
MAX_PRECISION = 38
_INTEGRAL = (ByteType(), ShortType(), IntegerType(), LongType())
# Digits of the greatest value of each.
_DIGITS = dict(zip(_INTEGRAL, (3, 5, 10, 19)))


class SchemaConflict(ValueError):
    """A schema that the table's files could not be read by."""


@dataclass(frozen=True)
class Version:
    """A table's schema, and SQL constants that stand for columns older files lack."""

    number: int
    schema: StructType
    defaults: Mapping[str, str] = field(default_factory=dict)

    def default(self, column: StructField) -> Column:
        text = self.defaults.get(column.name)
        return (F.lit(None) if text is None else F.expr(text)).cast(column.dataType)


def wider(a: DataType, b: DataType) -> DataType | None:
    """The narrowest type that holds every value of both, or None."""
    if a == b:
        return a
    if a in _INTEGRAL and b in _INTEGRAL:
        return max(a, b, key=_INTEGRAL.index)
    for one, other in ((a, b), (b, a)):
        if isinstance(one, DecimalType):
            if isinstance(other, DecimalType):
                digits, scale = other.precision - other.scale, other.scale
            elif other in _INTEGRAL:
                digits, scale = _DIGITS[other], 0
            else:
                return None
            scale = max(scale, one.scale)
            precision = max(digits, one.precision - one.scale) + scale
            return DecimalType(precision, scale) if precision <= MAX_PRECISION else None
        if isinstance(one, DoubleType) and isinstance(other, (FloatType, ByteType, ShortType, IntegerType)):
            return one
        if isinstance(one, FloatType) and isinstance(other, (ByteType, ShortType)):
            return one
    return None


def merged(current: StructType, incoming: StructType) -> StructType:
    """`current` with the columns and width that rows of `incoming` need."""
    names = [f.name.lower() for f in incoming]
    if len(set(names)) < len(names):
        raise SchemaConflict(f"column names differ in case only: {sorted(names)}")
    given = {f.name.lower(): f for f in incoming}
    fields = []
    for own in current:
        other = given.pop(own.name.lower(), None)
        kind = own.dataType if other is None else wider(own.dataType, other.dataType)
        if kind is None:
            raise SchemaConflict(
                f"{own.name} is {own.dataType.simpleString()}, "
                f"which does not widen to {other.dataType.simpleString()}"
            )
        fields.append(StructField(own.name, kind, True))
    return StructType([*fields, *(StructField(f.name, f.dataType, True) for f in given.values())])


def require_extension(current: StructType, wanted: StructType) -> None:
    """Refuse a schema that drops a column, or makes one narrower."""
    have = {f.name.lower(): f.dataType for f in wanted}
    for own in current:
        kind = have.get(own.name.lower())
        if kind is None:
            raise SchemaConflict(f"{own.name} may not be dropped")
        if wider(own.dataType, kind) != kind:
            raise SchemaConflict(
                f"{own.name} may not become {kind.simpleString()}: it is {own.dataType.simpleString()}"
            )


def _log(path: str) -> str:
    return f"{path.rstrip('/')}/_schema"


def versions(spark: SparkSession, path: str) -> list[Version]:
    """The table's schemas, oldest first. One whose writer failed half way does not count."""
    found = []
    for number, text in numbered_texts(spark, _log(path)).items():
        try:
            document = json.loads(text)
        except ValueError:
            continue
        found.append(Version(number, StructType.fromJson(document["schema"]), document["defaults"]))
    return found


def extend_schema(
    spark: SparkSession,
    path: str,
    wanted: StructType | None = None,
    *,
    rows_of: StructType | None = None,
    defaults: Mapping[str, str] | None = None,
) -> Version:
    """The table's schema, made to be `wanted`, or to hold rows of `rows_of`.

    Defaults are SQL constants for columns that are new; those of older columns stay.
    """
    while True:
        known = versions(spark, path)
        last = known[-1] if known else Version(0, StructType([]))
        if wanted is not None:
            require_extension(last.schema, wanted)
            schema = as_nullable(wanted)
        else:
            schema = merged(last.schema, rows_of)
        if schema == last.schema and known:
            return last
        added = {f.name for f in schema} - {f.name for f in last.schema}
        given = {n: text for n, text in (defaults or {}).items() if n in added}
        number = max([0, *numbered_texts(spark, _log(path))]) + 1
        new = Version(number, schema, {**last.defaults, **given})
        document = {"schema": json.loads(schema.json()), "defaults": dict(new.defaults)}
        if write_new(spark, f"{_log(path)}/{number:08d}.json", json.dumps(document, indent=1)):
            return new


def append_evolved(
    df: DataFrame,
    path: str,
    *,
    token: str | None = None,
    defaults: Mapping[str, str] | None = None,
) -> Version:
    """Append `df`, by column name, extending the table's schema where it must be.

    Columns `df` lacks take their default. With the token of an earlier append, its rows are
    replaced.
    """
    spark = df.sparkSession
    version = extend_schema(spark, path, rows_of=df.schema, defaults=defaults)
    token = token or uuid.uuid4().hex
    before = {
        number: child_folders(spark, folder, TOKEN).get(token)
        for number, folder in child_folders(spark, path, VERSION).items()
    }
    own = f"{path.rstrip('/')}/{VERSION}={version.number}/{TOKEN}={escaped(token)}"
    absent = {f.name.lower() for f in version.schema} - {c.lower() for c in df.columns}
    named = df.toDF(*[_spelt(c, version.schema) for c in df.columns])
    filled = named.withColumns(
        {f.name: version.default(f) for f in version.schema if f.name.lower() in absent}
    )
    conform(filled, version.schema).write.mode("overwrite").parquet(own)
    for number, folder in before.items():
        if folder and number != str(version.number):
            drop_folder(spark, folder)
    return version


def _spelt(name: str, schema: StructType) -> str:
    return next((f.name for f in schema if f.name.lower() == name.lower()), name)


def read_evolved(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """All rows, in the last schema or that of `version`; columns younger than it are left out, and
    values too wide for it fail the job."""
    known = versions(spark, path)
    if not known:
        raise FileNotFoundError(f"no table at {path}")
    wanted = next((v for v in known if v.number == version), None) if version else known[-1]
    if wanted is None:
        raise SchemaConflict(f"{path} has no version {version}")
    folders = child_folders(spark, path, VERSION)
    parts = []
    for own in known:
        folder = folders.get(str(own.number))
        if folder is None or not child_folders(spark, folder, TOKEN):
            continue
        rows = spark.read.schema(as_nullable(own.schema)).option("recursiveFileLookup", True).parquet(folder)
        have = set(own.schema.fieldNames())
        filled = rows.withColumns({f.name: wanted.default(f) for f in wanted.schema if f.name not in have})
        parts.append(conform(filled, wanted.schema))
    if not parts:
        return spark.createDataFrame([], wanted.schema)
    return reduce(DataFrame.unionByName, parts)
