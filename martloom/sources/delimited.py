"""Delimited landing files, read as text under a contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from martloom.operators.schema import require_columns
from martloom.sources.contract import MALFORMED, Contract

SOURCE_FILE = "source_file"


def scan_delimited(
    spark: SparkSession,
    path: str,
    contract: Contract,
    *,
    flag_malformed: bool = False,
    source_file: bool = False,
) -> DataFrame:
    """Contract columns as strings, found by header name; other columns are dropped.

    Only the header line is read up front. A missing column fails at once. With
    `flag_malformed`, rows with too few or too many fields get MALFORMED = true
    (only the flag is kept: the raw line may hold identifiers).
    """
    text = spark.read.option("header", True).option("sep", contract.delimiter)
    header = text.option("inferSchema", False).csv(path).columns
    require_columns(header, contract.names)

    schema = StructType([StructField(name, StringType()) for name in header])
    if flag_malformed:
        # Arity shows only if the parser sees every field of the line.
        schema = schema.add("_line", StringType())
        text = text.option("columnNameOfCorruptRecord", "_line").option("columnPruning", False)
    rows = text.option("enforceSchema", False).schema(schema).csv(path)

    columns = [F.col(f"`{name}`") for name in contract.names]
    if flag_malformed:
        columns.append(F.col("_line").isNotNull().alias(MALFORMED))
    if source_file:
        columns.append(F.col("_metadata.file_path").alias(SOURCE_FILE))
    return rows.select(*columns)
