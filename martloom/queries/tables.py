"""Scans and sinks: whole tables written to the shared folder and read back."""

from __future__ import annotations

import json
import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.operators.mapping import typed_cast
from martloom.operators.quality import row_counts
from martloom.operators.schema import columns
from martloom.queries.registry import query, read
from martloom.sources import catalog, evolving
from martloom.sources.contract import load_contract, parse_contract
from martloom.sources.delimited import SOURCE_FILE, scan_delimited
from martloom.sources.scratch import scratch_dir, stored
from martloom.sources.tables import (
    Table,
    append_rows,
    batch_slice,
    create_table,
    day_slice,
    empty_rows,
    read_table,
    replace_partition as replace_one,
    replace_touched_partitions,
    seed_table,
    slices_named_in,
    truncate_table,
)

_LINE_DOCUMENT = {
    "org": "main",
    "file_type": "orders",
    "delimiter": "|",
    "columns": [
        {"name": "order_number"},
        {"name": "note"},
        {"name": "order_date", "type": "date"},
        {"name": "amount", "type": "decimal"},
    ],
}
_LINE_CONTRACT = parse_contract(_LINE_DOCUMENT)
_TEXT_ORDERS = {
    "priority": "o_orderpriority",
    "order_number": "CAST(o_orderkey AS STRING)",
    "note": "o_orderstatus || ' | \"' || o_orderpriority || '\"'",
    "order_date": "CAST(CAST(o_orderdate AS DATE) AS STRING)",
    "amount": "CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS STRING)",
}


@query(f"""
    SELECT order_number, note, CAST(order_date AS DATE) AS order_date,
           CAST(amount AS DECIMAL(15,2)) AS amount
    FROM (SELECT {", ".join(f"{e} AS {n}" for n, e in _TEXT_ORDERS.items())} FROM orders)""", name="scan_delimited")
def scan_delimited_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns by header name, whatever their place; quotes and delimiters inside values."""
    path = scratch_dir(spark, "delimited")
    rows = read(spark, sf_dir, "orders").selectExpr(*[f"{e} AS {n}" for n, e in _TEXT_ORDERS.items()])
    rows.write.option("header", True).option("sep", "|").csv(path)
    return typed_cast(scan_delimited(spark, path, _LINE_CONTRACT), _LINE_CONTRACT)


@query("""
    SELECT event_id, ts, user_id, event_type FROM events
    WHERE ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-16'""", name="batch_slice")
def batch_slice_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range on the timestamp itself, which reaches the scan."""
    events = day_slice(read(spark, sf_dir, "events"), date(2024, 1, 15), "ts")
    return events.select("event_id", "ts", "user_id", "event_type")


_ORDERS = Table(
    "orders",
    columns(
        order_number="BIGINT NOT NULL",
        amount="DECIMAL(12,2)",
        org_code="STRING NOT NULL",
        batch_date="DATE NOT NULL",
    ),
    ("org_code", "batch_date"),
)
_FIRST, _SECOND = date(2026, 3, 31), date(2026, 4, 30)


def _orders(spark: SparkSession, sf_dir: str, batch: date) -> DataFrame:
    return read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_number"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("amount"),
        F.col("o_orderstatus").alias("org_code"),
        F.lit(batch).alias("batch_date"),
    )


_ORDERS_SQL = "SELECT o_orderkey AS order_number, CAST(o_totalprice AS DECIMAL(12,2)) AS amount, " \
    "o_orderstatus AS org_code"


@query(f"{_ORDERS_SQL}, DATE '{_SECOND}' AS batch_date FROM orders")
def partition_pruned_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One batch of a table that holds two; the other's folders are not read."""
    root = scratch_dir(spark, "slice")
    for batch in (_FIRST, _SECOND):
        append_rows(_orders(spark, sf_dir, batch), _ORDERS, root)
    return batch_slice(read_table(spark, _ORDERS, root), _SECOND)


@query(f"""
    SELECT * FROM (
        {_ORDERS_SQL}, DATE '{_FIRST}' AS batch_date FROM orders
        UNION ALL {_ORDERS_SQL}, DATE '{_SECOND}' AS batch_date FROM orders)
    WHERE batch_date = DATE '{_SECOND}' AND org_code IN (SELECT o_orderstatus FROM orders
        GROUP BY o_orderstatus HAVING count(*) < 0.3 * (SELECT count(*) FROM orders))""")
def partition_slice_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches that another table names: late ones of organisations with few orders."""
    root = scratch_dir(spark, "slices")
    for batch in (_FIRST, _SECOND):
        append_rows(_orders(spark, sf_dir, batch), _ORDERS, root)
    table = read_table(spark, _ORDERS, root)
    sizes = table.groupBy("org_code", "batch_date").agg(F.count(F.lit(1)).alias("n"))
    n_rows = read(spark, sf_dir, "orders").count()
    few = stored(sizes).where((F.col("n") < 0.3 * n_rows) & (F.col("batch_date") == F.lit(_SECOND)))
    return slices_named_in(table, few, ["org_code", "batch_date"])


@query(f"""
    {_ORDERS_SQL}, DATE '{_FIRST}' AS batch_date FROM orders
    UNION ALL {_ORDERS_SQL}, DATE '{_FIRST}' AS batch_date FROM orders WHERE o_orderstatus = 'F'""")
def append_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "append")
    orders = _orders(spark, sf_dir, _FIRST)
    append_rows(orders, _ORDERS, root)
    append_rows(orders.where(F.col("org_code") == "F").select(*reversed(orders.columns)), _ORDERS, root)
    return read_table(spark, _ORDERS, root)


@query(f"""
    {_ORDERS_SQL}, DATE '{_FIRST}' AS batch_date FROM orders WHERE o_orderstatus = 'O'
    UNION ALL
    SELECT o_orderkey, CAST(-o_totalprice AS DECIMAL(12,2)), o_orderstatus, DATE '{_FIRST}'
    FROM orders WHERE o_orderstatus = 'F'""", name="replace_partition")
def replace_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All loaded; then one organisation loaded again, and one with no rows at all."""
    root = scratch_dir(spark, "replace")
    orders = _orders(spark, sf_dir, _FIRST)
    append_rows(orders, _ORDERS, root)
    again = orders.where(F.col("org_code") == "F").withColumn("amount", -F.col("amount"))
    replace_touched_partitions(again, _ORDERS, root)
    nothing = empty_rows(spark, _ORDERS.schema)
    replace_one(nothing, _ORDERS, root, {"org_code": "P", "batch_date": _FIRST})
    return read_table(spark, _ORDERS, root)


_PARTS = Table("parts", columns(p_partkey="BIGINT NOT NULL", p_name="STRING", p_brand="STRING"))


@query("SELECT p_partkey, p_name, p_brand FROM part")
def seed_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeded twice; the second time changes nothing."""
    root = scratch_dir(spark, "seed")
    for _ in range(2):
        seed_table(read(spark, sf_dir, "part"), _PARTS, root)
    return read_table(spark, _PARTS, root)


@query("""
    SELECT 'before' AS table_name, count(*) AS n_rows FROM orders
    UNION ALL SELECT 'emptied', 0
    UNION ALL SELECT 'reloaded', count(*) FROM orders WHERE o_orderstatus = 'O'""")
def reset_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "reset")
    orders = _orders(spark, sf_dir, _FIRST)
    kept, emptied, reloaded = (f"{root}/{name}" for name in ("kept", "emptied", "reloaded"))
    append_rows(orders, _ORDERS, kept)
    for target in (emptied, reloaded):
        create_table(spark, _ORDERS, target)
        append_rows(orders, _ORDERS, target)
        truncate_table(spark, _ORDERS, target)
    append_rows(orders.where(F.col("org_code") == "O"), _ORDERS, reloaded)
    return row_counts(
        {
            "before": read_table(spark, _ORDERS, kept),
            "emptied": read_table(spark, _ORDERS, emptied),
            "reloaded": read_table(spark, _ORDERS, reloaded),
        }
    )


@query(f"""
    SELECT order_number, CAST(amount AS DECIMAL(15,2)) AS amount, priority AS source_folder
    FROM (SELECT {", ".join(f"{e} AS {n}" for n, e in _TEXT_ORDERS.items())} FROM orders)""")
def scan_with_source_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Under a contract read from a file; every row knows the file it came from."""
    path, contract_path = scratch_dir(spark, "delimited"), scratch_dir(spark, "contract")
    document = spark.createDataFrame([(json.dumps(_LINE_DOCUMENT),)], "value string")
    document.coalesce(1).write.text(contract_path)
    rows = read(spark, sf_dir, "orders").selectExpr(*[f"{e} AS {n}" for n, e in _TEXT_ORDERS.items()])
    folder = F.replace("priority", F.lit(" "), F.lit("_"))
    rows.withColumn("folder", folder).write.partitionBy("folder").option("header", True).option("sep", "|").csv(path)
    contract = load_contract(spark, f"{contract_path}/*.txt")
    found = typed_cast(scan_delimited(spark, f"{path}/*", contract, source_file=True), contract)
    source = F.regexp_extract(SOURCE_FILE, "folder=([^/]+)/", 1)
    return found.select("order_number", "amount", F.replace(source, F.lit("_"), F.lit(" ")).alias("source_folder"))


@query("""
    SELECT 'orders' AS table_name, o_orderstatus AS org_code, count(*) AS n_rows,
           CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DECIMAL(22,2)) AS amount FROM orders GROUP BY ALL
    UNION ALL
    SELECT 'recreated', o_orderstatus, count(*), CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DECIMAL(22,2))
    FROM orders WHERE o_orderstatus = 'O' GROUP BY ALL""")
def catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables by name: created, inserted into, one of them dropped and made anew, listed, and
    dropped with their database once they have been read."""
    database = f"martloom_{uuid.uuid4().hex}"
    again = Table("recreated", _ORDERS.schema, _ORDERS.partition_by)
    orders = _orders(spark, sf_dir, _FIRST)
    catalog.create_database(spark, database, scratch_dir(spark, "database"))
    try:
        catalog.create_tables(spark, database, [_ORDERS, again])
        for table in (_ORDERS, again):
            catalog.insert_rows(orders, database, table)
        catalog.recreate_tables(spark, database, [again])
        catalog.insert_rows(orders.where(F.col("org_code") == "O"), database, again)
        parts = [
            spark.table(catalog.quoted(database, name))
            .groupBy("org_code")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("amount").alias("amount"))
            .select(F.lit(name).alias("table_name"), "org_code", "n_rows", "amount")
            for name in catalog.list_tables(spark, database)
        ]
        return stored(parts[0].unionByName(parts[1]))
    finally:
        catalog.drop_database(spark, database)


@query("""
    SELECT o_orderkey AS order_number, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DECIMAL(14,4)) AS amount,
           CASE o_orderstatus WHEN 'F' THEN 'NOT STATED' ELSE o_orderpriority END AS priority,
           CASE o_orderstatus WHEN 'P' THEN CAST(o_orderdate AS DATE) END AS ordered
    FROM orders""")
def append_evolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three appends, each with more columns or wider ones; the second is made twice."""
    path = scratch_dir(spark, "evolved")
    orders = read(spark, sf_dir, "orders")
    amount = F.col("o_totalprice").cast("decimal(12,2)")
    first = orders.where("o_orderstatus = 'F'").select(
        F.col("o_orderkey").cast("int").alias("order_number"), amount.alias("amount")
    )
    second = orders.where("o_orderstatus NOT IN ('F', 'P')").select(
        F.col("o_orderpriority").alias("priority"), amount.alias("amount"), F.col("o_orderkey").alias("order_number")
    )
    third = orders.where("o_orderstatus = 'P'").select(
        F.col("o_orderdate").cast("date").alias("ordered"),
        F.col("o_orderkey").alias("order_number"),
        amount.cast("decimal(14,4)").alias("amount"),
        F.col("o_orderpriority").alias("priority"),
    )
    evolving.append_evolved(first, path, token="1")
    for _ in range(2):
        evolving.append_evolved(second, path, token="2", defaults={"priority": "'NOT STATED'"})
    evolving.append_evolved(third, path, token="3")
    return evolving.read_evolved(spark, path)
