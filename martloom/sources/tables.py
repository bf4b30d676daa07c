"""Parquet tables: how batches are read, replaced and appended.

Tables are folders of Parquet files. A partition that one load owns is written as a
folder of its own, so that loading the batch again, even with no rows, replaces exactly
that and leaves the loads of others alone.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from martloom.operators.mapping import timestamp
from martloom.operators.schema import conform
from martloom.operators.sizing import fits_broadcast


@dataclass(frozen=True)
class Table:
    """A table's schema and where it lies."""

    name: str
    schema: StructType
    partition_by: tuple[str, ...] = ()

    def path(self, root: str) -> str:
        return f"{root.rstrip('/')}/{self.name}"

    def without(self, *names: str) -> StructType:
        return StructType([f for f in self.schema if f.name not in names])


def as_nullable(schema: StructType) -> StructType:
    """File sources promise no NOT NULL, so reads do not either."""
    return StructType([type(f)(f.name, f.dataType, True, f.metadata) for f in schema])


def _path(spark: SparkSession, path: str):
    """A Hadoop path and its file system, for names and marks; data is left to Spark."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def child_folders(spark: SparkSession, path: str, column: str) -> dict[str, str]:
    """Value to folder, for the folders `column=value` right under `path`; one listing of names."""
    root, files = _path(spark, path)
    if not files.exists(root):
        return {}
    folders = [entry.getPath() for entry in files.listStatus(root)]
    named = [(f.getName().partition("="), f.toString()) for f in folders]
    return {unquote(value): folder for (name, _, value), folder in named if name == column}


def is_committed(spark: SparkSession, folder: str) -> bool:
    """Whether the job that wrote the folder has ended well."""
    mark, files = _path(spark, f"{folder}/_SUCCESS")
    return files.exists(mark)


def is_stream_sink(spark: SparkSession, path: str) -> bool:
    """Whether a stream writes the table; its log, which Spark reads, then says what is committed."""
    log, files = _path(spark, f"{path}/_spark_metadata")
    return files.exists(log)


def drop_folder(spark: SparkSession, path: str) -> None:
    target, files = _path(spark, path)
    files.delete(target, True)


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small text file that must not exist yet; False if it does."""
    target, files = _path(spark, path)
    if files.exists(target):
        return False
    try:
        out = files.create(target, False)
    except Py4JJavaError as error:
        if "AlreadyExists" not in str(error.java_exception.getClass()):
            raise
        return False
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def numbered_texts(spark: SparkSession, folder: str) -> dict[int, str]:
    """Number to text, for the files `<number>.json` of a folder."""
    root, files = _path(spark, folder)
    if not files.exists(root):
        return {}
    found = {}
    for entry in files.listStatus(root):
        stem, _, kind = entry.getPath().getName().partition(".")
        if kind == "json" and stem.isdigit():
            stream = files.open(entry.getPath())
            try:
                found[int(stem)] = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(
                    stream, "UTF-8"
                )
            finally:
                stream.close()
    return dict(sorted(found.items()))


def empty_rows(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows. The limit tells the optimizer so, which then drops joins with them."""
    return spark.createDataFrame([], as_nullable(schema)).limit(0)


def read_table(spark: SparkSession, table: Table, root: str) -> DataFrame:
    """The table, in its declared column order, even when it has no files yet."""
    df = spark.read.schema(as_nullable(table.schema)).parquet(table.path(root))
    return df.select(*table.schema.fieldNames())


def batch_slice(df: DataFrame, batch_date: date, column: str = "batch_date") -> DataFrame:
    """One batch. The literal is a DATE, so a partition column prunes folders."""
    return df.where(F.col(column) == F.lit(batch_date))


def slices_named_in(df: DataFrame, wanted: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of the batches that a table names, by partition columns of `df`.

    The list of batches is measured; where it is small, and only then, it is broadcast. If it is
    itself chosen by a comparison, the scan then takes the partitions from it when it runs: the
    other folders are not read.
    """
    names = wanted.select(*columns).distinct()
    if fits_broadcast(names):
        names = F.broadcast(names)
    return df.join(names, list(columns), "left_semi").select(*df.columns)


def day_slice(df: DataFrame, day: date, column: str) -> DataFrame:
    """Rows of one day by a timestamp column, as a range the scan can push down."""
    ts_type = df.schema[column].dataType
    start = F.lit(day).cast(ts_type)
    end = F.date_add(F.lit(day), 1).cast(ts_type)
    return df.where((F.col(column) >= start) & (F.col(column) < end))


def create_table(spark: SparkSession, table: Table, root: str) -> None:
    """An empty table, unless there is one."""
    empty = empty_rows(spark, table.schema)
    empty.write.mode("ignore").partitionBy(*table.partition_by).parquet(table.path(root))


def truncate_table(spark: SparkSession, table: Table, root: str) -> None:
    empty = empty_rows(spark, table.schema)
    empty.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
        *table.partition_by
    ).parquet(table.path(root))


def append_rows(df: DataFrame, table: Table, root: str) -> None:
    """Append by column name; partition folders are added to, not replaced."""
    conform(df, table.schema).write.mode("append").partitionBy(*table.partition_by).parquet(
        table.path(root)
    )


def escaped(value: str) -> str:
    """A folder-name value as Spark writes it."""
    return "".join(
        f"%{ord(ch):02X}" if ch in '"#%\'*/:=?\\{[]^\x7f' or ch < " " else ch for ch in value
    )


def partition_folder(table: Table, root: str, values: Mapping[str, object]) -> str:
    names = [f"{column}={escaped(str(value))}" for column, value in values.items()]
    return "/".join([table.path(root), *names])


def replace_partition(
    df: DataFrame,
    table: Table,
    root: str,
    values: Mapping[str, object],
    within: Sequence[str] = (),
    file_format: str = "parquet",
) -> None:
    """Make `df` the whole content of one partition folder; `within` lays out its inside.

    Columns named in `values` are carried by the folder and not written.
    """
    rows = df.drop(*values).write.format(file_format).option("header", True)
    # The mark `is_committed` looks for, whatever the cluster's default.
    rows = rows.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")
    rows.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*within).save(
        partition_folder(table, root, values)
    )


def drop_partition(
    spark: SparkSession, table: Table, root: str, values: Mapping[str, object]
) -> None:
    drop_folder(spark, partition_folder(table, root, values))


def replace_touched_partitions(df: DataFrame, table: Table, root: str) -> None:
    """Replace every partition `df` has rows for, in one job; others stay."""
    rows = conform(df, table.schema)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        *table.partition_by
    ).parquet(table.path(root))


def seed_table(df: DataFrame, table: Table, root: str) -> None:
    """Replace a reference table by its rows; seeding again changes nothing."""
    conform(df, table.schema).write.mode("overwrite").parquet(table.path(root))


def quarantine(
    df: DataFrame, org: str, batch_date: date, file_type: str, reason: str, load_timestamp: datetime
) -> DataFrame:
    """Whole rows as JSON, NULL fields kept, with the reason they could not be loaded."""
    return df.select(
        F.lit(org).alias("org_code"),
        F.lit(batch_date).alias("batch_date"),
        F.lit(file_type).alias("file_type"),
        F.lit(reason).alias("rejection_reason"),
        F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("raw_record"),
        timestamp(load_timestamp).alias("load_timestamp"),
    )
