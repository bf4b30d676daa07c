"""Files loaded and read back: checked rows, rejects, quarantine, and all a contract asks for."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.operators.validate import REASON
from martloom.plans.mart import fallback_columns, policyholder_rows
from martloom.plans.policy_mart import CONTRACTS, STAGING
from martloom.plans.staging import REJECTS, contract_table, load_file
from martloom.queries.landing import BATCHES, LANDINGS, LOADED, ORGS
from martloom.queries.mart import checked_sql, staged
from martloom.queries.registry import query, read
from martloom.sources.contract import Contract, parse_contract
from martloom.sources.scratch import scratch_dir
from martloom.sources.tables import read_table

_BATCH, _LOADED = date(2026, 3, 31), datetime(2026, 3, 31, 6, 0, 0)


def _write_lines(rows: DataFrame, names: list[str], path: str) -> None:
    """Files of raw lines (column `line`), each under a header: the header is the column's name,
    and the delimiter one that no line holds."""
    lines = rows.select(F.col("line").alias(",".join(names)))
    lines.write.option("header", True).option("sep", "\x01").option("quote", "").csv(path)


def _loaded(spark: SparkSession, contract: Contract, path: str, root: str, **options) -> tuple[DataFrame, DataFrame]:
    """A file loaded under its contract alone; its staging rows and its rejects, read back."""
    load_file(spark, path, contract, root, _BATCH, _LOADED, **options)
    table = contract_table(contract)
    rejects = f"{REJECTS.path(root)}/file_org={contract.org}/batch_date={_BATCH}/file_type={contract.file_type}"
    return read_table(spark, table, root), spark.read.parquet(rejects)


# A file type the mart does not know.
_ORDERS = parse_contract(
    {
        "org": "main",
        "file_type": "orders",
        "columns": [
            {"name": "order_id", "nullable": False},
            {"name": "order_date", "type": "date"},
            {"name": "amount", "type": "decimal(10,2)"},
            {"name": "customer", "type": "bigint"},
            {"name": "org_code"},
            {"name": "priority"},
        ],
        "not_null_check": ["order_id", "order_date"],
    }
)
_LINE = {
    "order_id": "CAST(o_orderkey AS STRING)",
    "order_date": "CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '3-MEDIUM' THEN '1999-02-30' "
    "WHEN o_orderstatus = 'P' THEN '31/12/1999' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END",
    "amount": "CASE WHEN o_totalprice > 400000 THEN 'n/a' "
    "WHEN o_totalprice > 380000 THEN '123456789012.00' "
    "ELSE CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS STRING) END",
    "customer": "CASE WHEN o_totalprice < 20000 THEN '7.5' ELSE CAST(o_custkey AS STRING) END",
    "org_code": "'main'",
    "priority": "o_orderpriority",
}
_LONG = "o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'"
_SHORT = "o_orderpriority = '5-LOW' AND o_orderstatus = 'O'"


@query(f"""
    SELECT order_id, CASE WHEN reason IS NULL THEN CAST(order_date AS DATE) END AS order_date,
           CASE WHEN reason IS NULL THEN CAST(amount AS DECIMAL(10,2)) END AS amount,
           CASE WHEN reason IS NULL THEN CAST(customer AS BIGINT) END AS customer,
           reason AS rejection_reason
    FROM (SELECT *, CASE WHEN malformed THEN 'malformed_row'
              WHEN NOT regexp_full_match(order_date, '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN 'invalid_date_format: order_date'
              WHEN TRY_CAST(order_date AS DATE) IS NULL THEN 'invalid_date: order_date'
              WHEN TRY_CAST(amount AS DECIMAL(10,2)) IS NULL THEN 'invalid_decimal: amount'
              WHEN NOT regexp_full_match(customer, '\\d+') THEN 'invalid_bigint: customer' END AS reason
          FROM (SELECT {", ".join(f"{e} AS {n}" for n, e in _LINE.items())},
                       ({_LONG}) OR ({_SHORT}) AS malformed FROM orders))""")
def load_strict_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows too long or too short, unreadable and too wide numbers and impossible dates are
    rejects; a file type with nothing but a contract gets a table of its own."""
    path, root = scratch_dir(spark, "landing"), scratch_dir(spark, "staging")
    whole = F.concat_ws(",", *[F.expr(e) for e in _LINE.values()])
    short = F.concat_ws(",", *[F.expr(e) for e in list(_LINE.values())[:-1]])
    line = F.when(F.expr(_LONG), F.concat(whole, F.lit(",one,two"))).when(F.expr(_SHORT), short)
    _write_lines(read(spark, sf_dir, "orders").select(line.otherwise(whole).alias("line")), list(_LINE), path)
    valid, rejected = _loaded(spark, _ORDERS, path, root)
    columns = ["order_id", "order_date", "amount", "customer"]
    nothing = [F.lit(None).cast(valid.schema[c].dataType).alias(c) for c in columns[1:]]
    return valid.select(*columns, F.lit(None).cast("string").alias(REASON)).unionByName(
        rejected.select("order_id", *nothing, REASON)
    )


def _landed(spark: SparkSession, sf_dir: str, file_type: str) -> dict[str, str]:
    """The first batch's files of one type, by organisation."""
    path = scratch_dir(spark, "landing")
    rows = LANDINGS[file_type].rows(spark, sf_dir, BATCHES[0])
    rows.write.partitionBy("file_org").option("header", True).csv(path)
    return {org: f"{path}/file_org={org}" for org in ORGS}


@query(f"""
    SELECT file_org, transaction_id, premium_date, amount, rejection_reason
    FROM ({checked_sql("premiums", BATCHES[0])}) WHERE rejection_reason IS NOT NULL""")
def reject_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects of two organisations' files as the sink holds them; one file is loaded twice."""
    root = scratch_dir(spark, "staging")
    files = _landed(spark, sf_dir, "premiums")
    for org in (*ORGS, ORGS[0]):
        contract = CONTRACTS["premiums"].for_org(org)
        load_file(spark, files[org], contract, root, BATCHES[0], LOADED[BATCHES[0]])
    rejects = spark.read.parquet(REJECTS.path(root))
    return rejects.select("file_org", "transaction_id", "premium_date", "amount", REASON)


_ADDRESSES = checked_sql("address", BATCHES[0])
_NO_CITY = replace(
    CONTRACTS["address"],
    columns=tuple(c for c in CONTRACTS["address"].columns if c.name != "city"),
    not_null=tuple(n for n in CONTRACTS["address"].not_null if n != "city"),
)


@query(f"""
    SELECT 'staged' AS sink, org_code, policy_number, street1 AS street, CAST(NULL AS VARCHAR) AS rejection_reason
    FROM ({_ADDRESSES}) WHERE rejection_reason IS NULL
    UNION ALL
    SELECT 'quarantined', file_org, policy_number, street1, 'schema mismatch: missing: city'
    FROM ({_ADDRESSES}) WHERE file_org = 'ail'
      AND (rejection_reason IS NULL OR rejection_reason = 'null_or_empty: city')""")
def quarantine_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good files are staged; then one organisation's file comes under a contract that lacks a
    column. Its rows are quarantined as they were landed, and the good rows are still there."""
    root = scratch_dir(spark, "staging")
    files = _landed(spark, sf_dir, "address")
    stamp = (BATCHES[0], LOADED[BATCHES[0]])
    for org in ORGS:
        load_file(spark, files[org], CONTRACTS["address"].for_org(org), root, *stamp)
    load_file(spark, files["ail"], _NO_CITY.for_org("ail"), root, *stamp)
    good = read_table(spark, STAGING["address"], root).select(
        F.lit("staged").alias("sink"),
        "org_code",
        "policy_number",
        F.col("street_address").alias("street"),
        F.lit(None).cast("string").alias(REASON),
    )
    raw = F.from_json("raw_record", "policy_number string, street1 string")
    reason = F.regexp_replace(REASON, "; unexpected.*", "")
    held = read_table(spark, STAGING["rejected"], root).select(
        F.lit("quarantined").alias("sink"),
        "org_code",
        raw["policy_number"].alias("policy_number"),
        raw["street1"].alias("street"),
        reason.alias(REASON),
    )
    return good.unionByName(held)


_CUSTOMERS = parse_contract(
    {
        "org": "main",
        "file_type": "customers",
        "columns": [
            {"name": "customer", "nullable": False},
            {"name": "name", "pii": True},
            {"name": "born", "type": "date"},
            {"name": "balance", "type": "decimal(12,2)"},
            {"name": "segment"},
        ],
        "not_null_check": ["customer", "segment"],
        "pii_fields": ["born"],
    }
)
_CUSTOMER = {
    "customer": "CAST(c_custkey AS STRING)",
    "name": "c_name",
    "born": "CAST(CAST('1950-01-01' AS DATE) + CAST(c_custkey % 9000 AS INT) AS STRING)",
    "balance": "CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS STRING)",
    "segment": "CASE WHEN c_nationkey = 5 THEN ' ' ELSE c_mktsegment END",
}


@query(f"""
    SELECT customer, sha256(name) AS name, sha256(left(born, 10)) AS born_hash, CAST(balance AS DECIMAL(12,2)) AS balance,
           CASE WHEN trim(segment) = '' THEN 'null_or_empty: segment' END AS rejection_reason
    FROM (SELECT {", ".join(f"{e} AS {n}" for n, e in _CUSTOMER.items())} FROM customer)""")
def contract_masking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a contract marks as personal is hidden in valid rows and rejects alike."""
    path, root = scratch_dir(spark, "landing"), scratch_dir(spark, "staging")
    rows = read(spark, sf_dir, "customer").selectExpr(*[f"{e} AS {n}" for n, e in _CUSTOMER.items()])
    rows.write.option("header", True).csv(path)
    valid, rejected = _loaded(spark, _CUSTOMERS, path, root)
    columns = ["customer", "name", "born_hash", F.col("balance").cast("decimal(12,2)").alias("balance")]
    none = F.lit(None).cast("string").alias(REASON)
    both = valid.select(*columns, "born", none).unionByName(
        rejected.select(*columns, F.col("born").cast("date").alias("born"), REASON)
    )
    return both.where("born IS NULL").drop("born")


@query(rf"""
    SELECT DISTINCT coalesce(CASE WHEN trim(ssn) <> '' THEN sha256(trim(ssn)) END,
               first_name || ' ' || last_name || '_' || dob || '_NAME_DOB') AS policyholder_business_key
    FROM ({checked_sql("basic", BATCHES[0])}) WHERE rejection_reason IS NULL""")
def fallback_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who has no identifier goes by the columns the contract names, the birth date among them."""
    rows, _ = staged(spark, sf_dir, "basic", BATCHES[0])
    people = policyholder_rows(rows, fallback_columns(CONTRACTS["basic"]))
    return people.select("policyholder_business_key").distinct()
