"""Landing file to staging rows and rejects."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from martloom.operators.mapping import ColumnMapping, add_audit, map_columns, typed_cast
from martloom.operators.schema import columns, conform, schema_diff
from martloom.operators.validate import (
    load_counts,
    mask_identifier,
    mask_marked,
    split,
    validate,
)
from martloom.plans.policy_mart import MAPPINGS, MASKS, STAGING
from martloom.sources.contract import Contract
from martloom.sources.delimited import scan_delimited
from martloom.sources.tables import (
    Table,
    drop_partition,
    quarantine,
    replace_partition,
)


# Rows that failed a check, as text. Other columns depend on the file type, which is a folder.
REJECTS = Table(
    "rejected",
    columns(
        rejection_reason="STRING", load_timestamp="TIMESTAMP", file_org="STRING",
        batch_date="DATE", file_type="STRING",
    ),
    ("file_org", "batch_date", "file_type"),
)


@dataclass(frozen=True)
class LoadCounts:
    total: int
    valid: int
    rejected: int
    quarantined: int = 0


def table_types(contract: Contract) -> dict[str, DataType]:
    """The staging table's types under the landing names."""
    if contract.file_type not in STAGING:
        return {}
    renamed = MAPPINGS[contract.file_type].renamed
    schema = STAGING[contract.file_type].schema
    names = {name: renamed.get(name, name) for name in contract.names}
    return {n: schema[t].dataType for n, t in names.items() if t in schema.fieldNames()}


def check_rows(
    rows: DataFrame,
    contract: Contract,
    batch_date: date,
    load_timestamp: datetime,
    *,
    strict: bool = True,
    salt: str | None = None,
    expected_org: Column | None = None,
) -> DataFrame:
    """Landing rows judged, masked and stamped, still as text. One narrow projection.

    What the contract marks as personal is hidden before valid rows and rejects part.
    """
    judged = validate(
        rows, contract, strict=strict, expected_org=expected_org, types=table_types(contract)
    )
    mask = MASKS.get(contract.file_type)
    judged = mask_marked(judged, contract, salt, elsewhere=mask.dropped if mask else ())
    judged = mask_identifier(judged, contract, salt)
    if mask:
        judged = map_columns(judged, mask)
    return add_audit(judged, batch_date, load_timestamp)


def staging_rows(valid: DataFrame, contract: Contract) -> DataFrame:
    """Valid rows, typed and under the staging table's names, not yet cut to its columns."""
    mapping = MAPPINGS.get(contract.file_type, ColumnMapping())
    return map_columns(typed_cast(valid, contract), mapping)


def contract_table(contract: Contract) -> Table:
    """A staging table for a file type that has none: the contract's own columns and types, as
    they are once personal values are hidden."""
    fields = [StructField("org_code", StringType()), StructField("batch_date", DateType())]
    for c in contract.columns:
        if c.name == contract.id_field:
            fields += [StructField(n, StringType()) for n in ("ssn_hash", "match_method")]
        elif c.name not in ("org_code", "batch_date"):
            fields.append(StructField(c.name, c.spark_type))
            if c.pii and c.type != "string":
                fields.append(StructField(f"{c.name}_hash", StringType()))
    fields.append(StructField("load_timestamp", TimestampType()))
    return Table(f"stg_{contract.file_type}", StructType(fields), ("org_code", "batch_date"))


def stage(
    rows: DataFrame,
    contract: Contract,
    batch_date: date,
    load_timestamp: datetime,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """(staging rows, rejects) of landing rows; options as for `check_rows`."""
    checked = check_rows(rows, contract, batch_date, load_timestamp, **options)
    valid, rejected = split(checked)
    table = STAGING[contract.file_type]
    return conform(staging_rows(valid, contract), table.schema), rejected


def load_file(
    spark: SparkSession,
    path: str,
    contract: Contract,
    root: str,
    batch_date: date,
    load_timestamp: datetime,
    *,
    strict: bool = True,
    salt: str | None = None,
    reject_format: str = "parquet",
    table: Table | None = None,
) -> LoadCounts:
    """Load one landing file into its staging partition, and its rejects beside it.

    Rows with too few or too many fields, impossible dates and unreadable or too wide numbers
    are rejects; with `strict=False` (the literal mode) fields are cut or filled up, and such
    values load as NULL.

    The counts are taken while the valid rows are written, so a clean file is read once;
    only a file with rejects is read again, to write those. All that an earlier load of the
    same file wrote is replaced, but for a file whose contract cannot fill its table: its valid
    rows are quarantined, masked but as they were landed, and staging rows stay as they are.

    A file type without a staging table goes to `table`, by default one made from its contract.
    """
    rows = scan_delimited(spark, path, contract, flag_malformed=strict)
    checked = check_rows(rows, contract, batch_date, load_timestamp, strict=strict, salt=salt)
    # Exact under task retries: the write is a single stage, and Spark counts each task once.
    seen = Observation(f"{contract.org}-{contract.file_type}")
    valid, _ = split(checked.observe(seen, *load_counts()))
    _, rejected = split(checked)
    staged = staging_rows(valid, contract)
    if contract.org_field not in contract.names and "org_code" not in staged.columns:
        staged = staged.withColumn("org_code", F.lit(contract.org))

    table = table or STAGING.get(contract.file_type) or contract_table(contract)
    held = STAGING["rejected"]
    owned = {"org_code": contract.org, "batch_date": batch_date}
    owned_quarantine = owned | {"file_type": contract.file_type}
    # Rejects keep their own organisation column: it may be what is wrong with them.
    owned_rejects = {
        "file_org": contract.org, "batch_date": batch_date, "file_type": contract.file_type
    }
    diff = schema_diff(staged.schema, table.schema)
    if diff.missing:
        # These cannot become rows of the table: load nothing, but keep them whole.
        reason = f"schema mismatch: {diff}"
        kept = quarantine(
            valid.drop("batch_date", "load_timestamp"),
            contract.org, batch_date, contract.file_type, reason, load_timestamp,
        )
        replace_partition(kept, held, root, owned_quarantine)
    else:
        replace_partition(conform(staged, table.schema), table, root, owned)
        drop_partition(spark, held, root, owned_quarantine)

    counts = LoadCounts(**seen.get)
    if counts.rejected:
        replace_partition(rejected, REJECTS, root, owned_rejects, file_format=reject_format)
    else:
        drop_partition(spark, REJECTS, root, owned_rejects)
    return replace(counts, valid=0, quarantined=counts.valid) if diff.missing else counts


def load_audit(checked: DataFrame, by: str) -> DataFrame:
    """Rows in, loaded and rejected, for each value of `by`; one pass."""
    return checked.groupBy(by).agg(*load_counts())
