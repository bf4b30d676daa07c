"""Files that keep arriving in a landing folder, loaded once each.

The checks are narrow projections, so they run on a stream as they are. The stream's
checkpoint remembers which files have been read, and the file sink which rows have been
published, so a restart after a failure neither loses nor repeats any.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from martloom.plans.policy_mart import STAGING
from martloom.plans.staging import REJECTS, stage
from martloom.sources.contract import MALFORMED, Contract

# How much older than the newest file a file may be: a century, so none is passed over.
MAX_FILE_AGE = "36500d"


def landing_stream(
    spark: SparkSession,
    folder: str,
    contract: Contract,
    files_per_trigger: int = 1000,
    max_file_age: str = MAX_FILE_AGE,
) -> DataFrame:
    """New files of the folder, however late they come; rows of another arity are flagged.

    Unlike a batch, a stream has one schema for files it has not seen: their header must name
    the contract's columns in the contract's order, or the stream fails.
    """
    schema = StructType([StructField(name, StringType()) for name in [*contract.names, "_line"]])
    reader = spark.readStream.schema(schema).option("header", True).option("sep", contract.delimiter)
    reader = reader.option("columnNameOfCorruptRecord", "_line").option("columnPruning", False)
    reader = reader.option("maxFilesPerTrigger", files_per_trigger).option("maxFileAge", max_file_age)
    rows = reader.option("enforceSchema", False).csv(folder)
    return rows.withColumn(MALFORMED, F.col("_line").isNotNull()).drop("_line")


def load_arrivals(
    spark: SparkSession,
    folder: str,
    contract: Contract,
    root: str,
    batch_date: date,
    load_timestamp: datetime,
    checkpoint: str,
    *,
    max_file_age: str = MAX_FILE_AGE,
    **options,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Stage what has arrived and not been staged yet, then stop. One root per stream.

    Valid rows and rejects are two streams, each with its own record of what it has done.
    Options as for `check_rows`, such as `strict` and `salt`.
    """
    rows = landing_stream(spark, folder, contract, max_file_age=max_file_age)
    valid, rejected = stage(rows, contract, batch_date, load_timestamp, **options)
    rejected = rejected.withColumns(
        {"file_org": F.lit(contract.org), "file_type": F.lit(contract.file_type)}
    )
    table = STAGING[contract.file_type]
    return (
        _start(valid, table.path(root), table.partition_by, f"{checkpoint}/valid"),
        _start(rejected, REJECTS.path(root), REJECTS.partition_by, f"{checkpoint}/rejected"),
    )


def _start(
    rows: DataFrame, path: str, partition_by: Sequence[str], checkpoint: str
) -> StreamingQuery:
    sink = rows.writeStream.format("parquet").partitionBy(*partition_by)
    sink = sink.option("path", path).option("checkpointLocation", checkpoint)
    return sink.trigger(availableNow=True).start()
