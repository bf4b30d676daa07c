"""Quality checks on whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.operators import profile, quality
from martloom.queries.merges import CUSTOMER, CUSTOMER_DIM_SQL, customer_dim
from martloom.operators.schema import columns
from martloom.queries.registry import query, read
from martloom.sources import catalog
from martloom.sources.scratch import scratch_dir, stored

_TABLES = ("customer", "orders", "lineitem", "supplier", "events")


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in _TABLES))
def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.row_counts({t: read(spark, sf_dir, t) for t in _TABLES})


@query("SELECT count(*) AS n_rows, max(CAST(o_totalprice AS DECIMAL(12,2))) AS max_value FROM orders")
def count_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("o_totalprice").cast("decimal(12,2)").alias("price")
    return quality.count_and_max(read(spark, sf_dir, "orders").select(price), "price")


@query("SELECT o_orderpriority, o_orderstatus, count(*) AS n_rows FROM orders GROUP BY ALL")
def group_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.group_counts(read(spark, sf_dir, "orders"), ["o_orderpriority", "o_orderstatus"])


@query("SELECT l_orderkey, count(*) AS n_rows FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1")
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_keys(read(spark, sf_dir, "lineitem"), ["l_orderkey"])


@query("""
    SELECT count(*) AS n_keys FROM (
        SELECT DISTINCT l_orderkey, CASE WHEN l_quantity < 50 THEN l_linenumber END AS line
        FROM lineitem WHERE l_quantity < 50)""")
def distinct_key_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.when(F.col("l_quantity") < 50, F.col("l_linenumber")).alias("line")
    keys = read(spark, sf_dir, "lineitem").select("l_orderkey", line)
    return quality.distinct_key_count(keys, ["l_orderkey", "line"])


_SPARSE_CUSTOMER = {
    "c_custkey": "c_custkey",
    "c_name": "CASE WHEN c_acctbal >= 0 THEN c_name END",
    "c_mktsegment": "CASE WHEN c_nationkey <> 3 THEN c_mktsegment END",
}
_SPARSE_SQL = f"SELECT {', '.join(f'{e} AS {n}' for n, e in _SPARSE_CUSTOMER.items())} FROM customer"


def _sparse_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read(spark, sf_dir, "customer")
    return customer.selectExpr(*[f"{e} AS {n}" for n, e in _SPARSE_CUSTOMER.items()])


@query(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS n_nulls FROM ({_SPARSE_SQL})"
    for c in _SPARSE_CUSTOMER
))
def null_key_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_counts(_sparse_customer(spark, sf_dir), list(_SPARSE_CUSTOMER))


@query(f"""
    SELECT 'c_custkey' AS column_name, 'ok' AS status, count(*) FILTER (c_custkey IS NULL) AS n_nulls
        FROM ({_SPARSE_SQL})
    UNION ALL SELECT 'c_name', CASE WHEN count(*) FILTER (c_name IS NULL) > 0 THEN 'has_nulls'
                               ELSE 'ok' END, count(*) FILTER (c_name IS NULL) FROM ({_SPARSE_SQL})
    UNION ALL SELECT 'c_mktsegment', 'forbidden', count(*) FILTER (c_mktsegment IS NULL) FROM ({_SPARSE_SQL})
    UNION ALL SELECT 'c_phone', 'missing', NULL""")
def schema_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = columns(c_custkey="BIGINT NOT NULL", c_name="STRING NOT NULL", c_phone="STRING")
    return quality.column_report(_sparse_customer(spark, sf_dir), wanted, ["c_mktsegment"])


@query("SELECT o_orderkey, o_custkey, o_orderdate FROM orders "
       "WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' ORDER BY o_orderkey")
def ordered_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders")
    urgent = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F")
    return orders.where(urgent).select("o_orderkey", "o_custkey", "o_orderdate").orderBy("o_orderkey")


@query("""
    SELECT c_mktsegment AS value, count(*) AS n_rows FROM customer
    WHERE c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING', 'MACHINERY') GROUP BY c_mktsegment""")
def domain_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read(spark, sf_dir, "customer")
    return quality.outside_list(customer, "c_mktsegment", ["AUTOMOBILE", "BUILDING", "MACHINERY"])


@query("""
    SELECT c_nationkey AS value, count(*) AS n_rows FROM customer
    WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey <> 1)
    GROUP BY c_nationkey""")
def domain_check_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of nations that a reference table, here without one region, lacks."""
    allowed = read(spark, sf_dir, "nation").where(F.col("n_regionkey") != 1)
    return quality.outside_domain(
        read(spark, sf_dir, "customer"), "c_nationkey", allowed, "n_nationkey"
    )


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders")
    return orders.select("o_orderkey", F.col("o_custkey").alias("customer_id"), "o_orderdate")


_ORDERS_WITH_CUSTOMERS = f"""
    SELECT o.o_custkey AS customer_id, o.o_orderkey, o.o_orderdate, d.status, d.priority
    FROM orders o JOIN (SELECT * FROM ({CUSTOMER_DIM_SQL}) WHERE is_current) d
      ON o.o_custkey = d.customer_id"""


@query(_ORDERS_WITH_CUSTOMERS)
def fact_dim_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = customer_dim(spark, sf_dir)
    return quality.fact_dim_join(
        _orders(spark, sf_dir), dim, ["customer_id"], ["status", "priority"]
    )


@query(_ORDERS_WITH_CUSTOMERS)
def fact_dim_join_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan for a dimension too big to broadcast, customers with many orders set apart."""
    dim = stored(customer_dim(spark, sf_dir))
    return quality.fact_dim_join(
        _orders(spark, sf_dir), dim, ["customer_id"], ["status", "priority"],
        broadcast_right=False, hot_rows=15,
    )


@query(_ORDERS_WITH_CUSTOMERS)
def fact_dim_join_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts and dimension kept in buckets of the key, which meet without a shuffle."""
    database = f"martloom_{uuid.uuid4().hex}"
    catalog.create_database(spark, database, scratch_dir(spark, "bucketed"))
    try:
        keys = ["customer_id"]
        facts = catalog.write_bucketed(_orders(spark, sf_dir), database, "facts", keys, 8)
        dim = catalog.write_bucketed(customer_dim(spark, sf_dir), database, "dim", keys, 8)
        joined = quality.fact_dim_join(facts, dim, keys, ["status", "priority"], broadcast_right=False)
        return stored(joined)
    finally:
        catalog.drop_database(spark, database)


_PROFILED = {"o_orderkey": "number", "total": "number", "o_orderpriority": "text", "ordered": "text"}


def _profile_sql(column: str, kind: str) -> str:
    number, text = (column, "NULL") if kind == "number" else ("NULL", column)
    return f"""
        SELECT '{column}' AS column_name, count(*) AS n_rows, count(*) - count({column}) AS n_nulls,
               CAST(min({text}) AS VARCHAR) AS least, CAST(max({text}) AS VARCHAR) AS greatest,
               CAST(min({number}) AS DECIMAL(38,10)) AS least_number,
               CAST(max({number}) AS DECIMAL(38,10)) AS greatest_number FROM o"""


@query(f"""
    WITH o AS (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(12,2)) AS total, o_orderpriority,
                      CASE o_orderstatus WHEN 'P' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS ordered
               FROM orders) {" UNION ALL ".join(_profile_sql(c, k) for c, k in _PROFILED.items())}""")
def partition_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles of parts, of which the last comes later, added up to that of the whole table."""
    root = scratch_dir(spark, "profiles")
    status = F.col("o_orderstatus")
    orders = read(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_totalprice").cast("decimal(12,2)").alias("total"),
        "o_orderpriority",
        F.when(status != "P", F.col("o_orderdate").cast("date")).alias("ordered"),
        status,
    )
    parts = {}
    for part, chosen in (("F", status == "F"), ("O", status == "O"), ("rest", ~status.isin("F", "O"))):
        parts[part] = f"{root}/rows/{part}"
        orders.where(chosen).drop("o_orderstatus").write.parquet(parts[part])
        schema = orders.drop("o_orderstatus").schema
        profile.profile_new_parts(spark, parts, schema, list(_PROFILED), f"{root}/profiles")
    whole = profile.merged(profile.kept_profiles(spark, f"{root}/profiles"))
    return whole.drop("distinct_values")


@query("""
    SELECT o_custkey AS customer_id, count(*) AS n_facts FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) GROUP BY o_custkey""")
def orphan_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of customers that the dimension, here without those in debt, lacks."""
    dim = read(spark, sf_dir, "customer").where(F.col("c_acctbal") >= 0)
    dim = dim.select(F.col("c_custkey").alias("customer_id"))
    return quality.orphans(_orders(spark, sf_dir), dim, ["customer_id"])


# A faulty history: every order opens a version of its customer and lasts 200 days, or stays
# open if it is for much money.
_VERSIONS = {
    "customer_id": "o_custkey",
    "is_current": "o_totalprice > 400000",
    "effective_date": "CAST(o_orderdate AS DATE)",
    "end_date": "CASE WHEN o_totalprice > 400000 THEN NULL WHEN o_totalprice < 5000 "
    "THEN CAST(o_orderdate - INTERVAL 1 DAY AS DATE) "
    "ELSE CAST(o_orderdate + INTERVAL 200 DAY AS DATE) END",
}
_VERSIONS_SQL = f"SELECT {', '.join(f'{e} AS {n}' for n, e in _VERSIONS.items())} FROM orders"


def _faulty_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").selectExpr(*[f"{e} AS {n}" for n, e in _VERSIONS.items()])


@query(f"""
    SELECT customer_id, count(*) AS n_rows FROM ({_VERSIONS_SQL}) WHERE is_current
    GROUP BY customer_id HAVING count(*) > 1""")
def multi_current_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.multiple_current(_faulty_history(spark, sf_dir), CUSTOMER)


@query(f"""
    WITH v AS ({_VERSIONS_SQL}),
         s AS (SELECT customer_id, effective_date AS at_date, count(*) AS n,
                      count(*) FILTER (end_date < effective_date) AS reversed FROM v GROUP BY ALL),
         e AS (SELECT customer_id, CAST(end_date + INTERVAL 1 DAY AS DATE) AS at_date, count(*) AS n
               FROM v GROUP BY ALL)
    SELECT customer_id, at_date, 'several_starts' AS fault FROM s WHERE n > 1
    UNION ALL SELECT customer_id, at_date, 'ends_before_start' FROM s WHERE reversed > 0
    UNION ALL SELECT customer_id, at_date, 'several_ends' FROM e WHERE n > 1 AND at_date IS NOT NULL
    UNION ALL SELECT customer_id, at_date, 'several_open' FROM e WHERE n > 1 AND at_date IS NULL
    UNION ALL SELECT customer_id, at_date, 'no_successor' FROM e ANTI JOIN s USING (customer_id, at_date)
              WHERE at_date IS NOT NULL""")
def scd2_interval_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.interval_faults(_faulty_history(spark, sf_dir), CUSTOMER)


@query("""
    SELECT n_nationkey, CASE WHEN n_nationkey = 3 THEN 'missing' WHEN n_nationkey = 105 THEN 'unexpected'
                             WHEN n_nationkey % 7 = 0 THEN 'changed' ELSE 'repeated' END AS status
    FROM (SELECT n_nationkey FROM nation UNION ALL SELECT 105)
    WHERE n_nationkey IN (3, 8, 105) OR n_nationkey % 7 = 0""")
def reference_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reference table against what it should hold, with faults planted by value."""
    nation = read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    name = F.when(F.col("n_nationkey") % 7 == 0, F.lower("n_name")).otherwise(F.col("n_name"))
    held = nation.where("n_nationkey <> 3").withColumn("n_name", name)
    more = nation.where("n_nationkey = 8").unionByName(
        nation.where("n_nationkey = 5").withColumn("n_nationkey", F.col("n_nationkey") + 100)
    )
    return quality.content_report(held.unionByName(more), nation, ["n_nationkey"])


@query("""
    SELECT 'lineitem' AS table_name, count(*) AS n_rows, 'too_many' AS fault FROM lineitem
    UNION ALL SELECT 'region', count(*), 'too_few' FROM region
    UNION ALL SELECT 'orders', count(*), 'not_below_customer' FROM orders""")
def implausible_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {t: read(spark, sf_dir, t) for t in ("region", "customer", "orders", "lineitem")}
    bounds = {"region": (6, None), "customer": (1, None), "orders": (1, None), "lineitem": (1, 10)}
    return quality.implausible_counts(
        tables, bounds, [("customer", "orders"), ("orders", "lineitem"), ("orders", "customer")]
    )
