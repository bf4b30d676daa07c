"""Row checks under a contract, the valid/reject split and its counts.

Everything here is one narrow projection: no shuffle, and one scan per consumer.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from martloom.functions import hash_identifier, is_blank, match_method, standardize_name
from martloom.operators.mapping import parse_value
from martloom.sources.contract import MALFORMED, Contract

REASON = "rejection_reason"


def not_null_check(name: str, contract: Contract) -> Column:
    return F.when(is_blank(F.col(name), contract.blank), F.lit(f"null_or_empty: {name}"))


def expected_value_check(name: str, expected: Column) -> Column:
    # NULL is no mismatch: the comparison is NULL, so no reason is given.
    return F.when(
        F.col(name) != expected, F.concat(F.lit(f"{name} mismatch: expected "), expected)
    )


def date_shape_check(name: str, contract: Contract) -> Column:
    """Shape only: 2026-99-99 passes."""
    column = next(c for c in contract.columns if c.name == name)
    # Well shaped, which most are and is tried first, or blank; a NULL is neither matched nor a fault.
    passes = rf"^{column.date_shape}$|\A[{contract.blank}]*\z"
    return F.when(~F.col(name).rlike(passes), F.lit(f"invalid_date_format: {name}"))


def cast_check(name: str, contract: Contract, data_type: DataType | None = None) -> Column:
    """A value that is there but cannot be read as the contract's type, or as `data_type`."""
    column = next(c for c in contract.columns if c.name == name)
    return F.when(
        ~is_blank(F.col(name), contract.blank) & parse_value(column, data_type).isNull(),
        F.lit(f"invalid_{column.type.partition('(')[0]}: {name}"),
    )


def row_checks(
    contract: Contract,
    *,
    strict: bool = True,
    expected_org: Column | None = None,
    types: Mapping[str, DataType] | None = None,
) -> list[Column]:
    """The contract as checks, in order of precedence; each is a reason or NULL.

    Not-null checks come first, then the organisation, then the shapes of dates, then
    impossible dates and unreadable or too wide numbers. Without `strict` (the literal mode)
    these last ones are no faults and load as NULL. `types` holds the types of columns whose table is narrower than the contract.
    `expected_org` replaces the contract's organisation where files of several are checked
    in one pass.
    """
    if expected_org is None:
        expected_org = F.lit(contract.org)
    checks = [not_null_check(name, contract) for name in contract.not_null]
    if contract.org_field in contract.names:
        checks.append(expected_value_check(contract.org_field, expected_org))
    checks += [date_shape_check(c.name, contract) for c in contract.of_type("date")]
    if strict:
        checks += [
            cast_check(c.name, contract, (types or {}).get(c.name)) for c in contract.typed()
        ]
    return checks


def first_reason(checks: Sequence[Column]) -> Column:
    return F.coalesce(*checks, F.lit(None).cast("string"))


def all_reasons(checks: Sequence[Column]) -> Column:
    return F.array_compact(F.array(*checks))


def standardize(df: DataFrame, contract: Contract) -> DataFrame:
    return df.withColumns(
        {n: standardize_name(F.col(n)) for n in contract.standardized if n in contract.names}
    )


def validate(df: DataFrame, contract: Contract, *, strict: bool = True, **options) -> DataFrame:
    """Contract rows, names standardised, plus the first reason to reject each, or NULL.

    Options as for `row_checks`.
    """
    checks = row_checks(contract, strict=strict, **options)
    if strict and MALFORMED in df.columns:
        checks.insert(0, F.when(F.col(MALFORMED), F.lit("malformed_row")))
    return standardize(df, contract).withColumn(REASON, first_reason(checks)).drop(MALFORMED)


def mask_marked(
    df: DataFrame, contract: Contract, salt: str | None = None, elsewhere: Sequence[str] = ()
) -> DataFrame:
    """Hide every column the contract marks as personal, in all rows, checks done.

    Text is replaced by its hash. A hash is no date or number: such a column becomes NULL, and
    its hash a column of its own. Left out are the identifier, which has its own rule, and
    columns `elsewhere`, which the caller hides.
    """
    hidden = {}
    for column in contract.columns:
        name = column.name
        if not column.pii or name == contract.id_field or name in elsewhere:
            continue
        hashed = hash_identifier(F.col(name), salt)
        if column.type == "string":
            hidden[name] = hashed
        else:
            hidden |= {f"{name}_hash": hashed, name: F.lit(None).cast("string")}
    return df.withColumns(hidden) if hidden else df


def mask_identifier(df: DataFrame, contract: Contract, salt: str | None = None) -> DataFrame:
    """Replace the contract's identifier by its hash and the match method."""
    if contract.id_field is None:
        return df
    raw = F.col(contract.id_field)
    return df.withColumns(
        {
            "ssn_hash": hash_identifier(raw, salt),
            "match_method": match_method(raw, contract.blank),
        }
    ).drop(contract.id_field)


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected): every row is in exactly one of the two."""
    valid = df.where(F.col(REASON).isNull()).drop(REASON)
    return valid, df.where(F.col(REASON).isNotNull())


def load_counts() -> list[Column]:
    """Aggregates over validated rows, for `agg` or `observe`."""
    return [
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col(REASON).isNull()).alias("valid"),
        F.count_if(F.col(REASON).isNotNull()).alias("rejected"),
    ]
