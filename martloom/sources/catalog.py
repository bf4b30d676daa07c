"""The same tables in the session catalog, for use by name from SQL."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession

from martloom.operators.schema import conform
from martloom.sources.tables import Table


def quoted(*names: str) -> str:
    return ".".join("`" + n.replace("`", "``") + "`" for n in names)


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)}{where}")


def create_tables(
    spark: SparkSession, database: str, tables: Iterable[Table], root: str | None = None
) -> None:
    """Managed tables, or tables over `root` if it is given."""
    for table in tables:
        columns = ", ".join(
            f"{quoted(f.name)} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}"
            for f in table.schema
        )
        layout = (
            f" PARTITIONED BY ({', '.join(quoted(c) for c in table.partition_by)})"
            if table.partition_by
            else ""
        )
        where = f" LOCATION '{table.path(root)}'" if root else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {quoted(database, table.name)} ({columns}) "
            f"USING parquet{layout}{where}"
        )


def insert_rows(df: DataFrame, database: str, table: Table) -> None:
    """Append in the table's column order."""
    names = [f.name for f in table.schema if f.name not in table.partition_by]
    ordered = conform(df, table.schema).select(*names, *table.partition_by)
    ordered.write.mode("append").insertInto(quoted(database, table.name))


def write_bucketed(
    df: DataFrame, database: str, name: str, keys: Sequence[str], buckets: int
) -> DataFrame:
    """A table whose rows lie in hash buckets of their keys, in order; read back by name.

    Two such tables with equal keys and numbers of buckets meet in a join on the keys without a shuffle
    of either, however often they are joined; the shuffle is paid once, here.
    """
    table = quoted(database, name)
    rows = df.repartition(buckets, *keys).write.mode("overwrite").format("parquet")
    rows.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
    return df.sparkSession.table(table)


def truncate_tables(spark: SparkSession, database: str, tables: Iterable[Table]) -> dict[str, str]:
    """Empty the tables that exist; returns what could not be emptied, and why."""
    failed = {}
    for table in tables:
        try:
            spark.sql(f"TRUNCATE TABLE {quoted(database, table.name)}")
        except Exception as error:  # one bad table must not keep the others full
            failed[table.name] = str(error).splitlines()[0]
    return failed


def recreate_tables(
    spark: SparkSession, database: str, tables: Sequence[Table], root: str | None = None
) -> None:
    for table in tables:
        spark.sql(f"DROP TABLE IF EXISTS {quoted(database, table.name)}")
    create_tables(spark, database, tables, root)


def drop_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"DROP DATABASE IF EXISTS {quoted(database)} CASCADE")


def list_tables(spark: SparkSession, database: str) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)


def list_databases(spark: SparkSession) -> list[str]:
    return sorted(d.name for d in spark.catalog.listDatabases())
