"""Contract checks, casts, masking and mapping on whole tables read as landing text."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions import (
    business_key,
    hash_identifier,
    last_characters,
    match_method,
    standardize_name,
)
from martloom.operators.mapping import ColumnMapping, add_audit, map_columns, typed_cast
from martloom.operators.schema import columns, conform
from martloom.operators.validate import all_reasons, row_checks, split, validate
from martloom.plans.staging import load_audit
from martloom.queries.registry import query, read
from martloom.sources.contract import parse_contract
from martloom.sources.tables import quarantine

# Orders as landing text, with faults planted by value.
DIRTY_ORDERS = {
    "order_id": "CASE WHEN o_totalprice < 20000 THEN '   ' ELSE CAST(o_orderkey AS STRING) END",
    "customer_id": "CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN NULL "
    "ELSE CAST(o_custkey AS STRING) END",
    "org_code": "CASE WHEN o_orderpriority = '5-LOW' THEN 'other' "
    "WHEN o_totalprice > 450000 THEN NULL ELSE 'main' END",
    "order_date": "CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '2-HIGH' THEN '31/12/1999' "
    "WHEN o_orderstatus = 'O' AND o_orderpriority = '3-MEDIUM' THEN '1999-02-30' "
    "ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END",
    "amount": "CASE WHEN o_orderstatus = 'O' AND o_totalprice > 400000 THEN 'n/a' "
    "ELSE CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS STRING) END",
    "priority": "o_orderpriority",
}
ORDER_CONTRACT = parse_contract(
    {
        "org": "main",
        "file_type": "orders",
        "columns": [
            {"name": "order_id", "type": "string", "nullable": False},
            {"name": "customer_id", "type": "string", "nullable": False},
            {"name": "org_code", "type": "string", "nullable": False},
            {"name": "order_date", "type": "date", "nullable": False, "format": "YYYY-MM-DD"},
            {"name": "amount", "type": "decimal", "nullable": False},
            {"name": "priority", "type": "string"},
        ],
        "not_null_check": ["order_id", "customer_id", "org_code", "order_date", "amount"],
    }
)


def dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders")
    return orders.selectExpr(*[f"{e} AS {n}" for n, e in DIRTY_ORDERS.items()])


_DIRTY = f"SELECT {', '.join(f'{e} AS {n}' for n, e in DIRTY_ORDERS.items())} FROM orders"
# The wording of reasons.
_NULL_OR_EMPTY = " ".join(
    f"WHEN {n} IS NULL OR trim({n}) = '' THEN 'null_or_empty: {n}'" for n in ORDER_CONTRACT.not_null
)
_SHAPED = r"regexp_full_match(order_date, '\d{4}-\d{2}-\d{2}')"
_REASON = f"""CASE {_NULL_OR_EMPTY}
    WHEN org_code <> 'main' THEN 'org_code mismatch: expected main'
    WHEN NOT {_SHAPED} THEN 'invalid_date_format: order_date' END"""
_JUDGED = f"SELECT *, {_REASON} AS rejection_reason FROM ({_DIRTY})"


@query(_JUDGED)
def validate_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate(dirty_orders(spark, sf_dir), ORDER_CONTRACT, strict=False)


@query(f"SELECT * EXCLUDE (rejection_reason) FROM ({_JUDGED}) WHERE rejection_reason IS NULL")
def valid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split(validate(dirty_orders(spark, sf_dir), ORDER_CONTRACT, strict=False))[0]


@query(f"SELECT * FROM ({_JUDGED}) WHERE rejection_reason IS NOT NULL")
def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split(validate(dirty_orders(spark, sf_dir), ORDER_CONTRACT, strict=False))[1]


@query(f"""
    SELECT *, concat_ws('; ',
        {", ".join(f"CASE WHEN {n} IS NULL OR trim({n}) = '' THEN 'null_or_empty: {n}' END"
                   for n in ORDER_CONTRACT.not_null)},
        CASE WHEN org_code <> 'main' THEN 'org_code mismatch: expected main' END,
        CASE WHEN NOT {_SHAPED} THEN 'invalid_date_format: order_date' END,
        CASE WHEN TRY_CAST(order_date AS DATE) IS NULL OR NOT {_SHAPED}
             THEN 'invalid_date: order_date' END,
        CASE WHEN TRY_CAST(amount AS DECIMAL(15,2)) IS NULL THEN 'invalid_decimal: amount' END
    ) AS reasons
    FROM ({_DIRTY})""")
def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reason of each row, strict checks included."""
    reasons = all_reasons(row_checks(ORDER_CONTRACT))
    return dirty_orders(spark, sf_dir).withColumn("reasons", F.array_join(reasons, "; "))


@query(f"""
    SELECT priority, count(*) AS total, count(*) FILTER (rejection_reason IS NULL) AS valid,
           count(*) FILTER (rejection_reason IS NOT NULL) AS rejected
    FROM ({_JUDGED}) GROUP BY priority""", name="load_audit")
def load_counts_by_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_audit(validate(dirty_orders(spark, sf_dir), ORDER_CONTRACT, strict=False), "priority")


@query(f"""
    SELECT order_id, customer_id, org_code, priority,
           CASE WHEN {_SHAPED} THEN TRY_CAST(order_date AS DATE) END AS order_date,
           TRY_CAST(amount AS DECIMAL(15,2)) AS amount
    FROM ({_DIRTY})""", name="typed_cast")
def typed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed_cast(dirty_orders(spark, sf_dir), ORDER_CONTRACT)


@query("""
    SELECT 'main' AS org_code, DATE '2026-03-31' AS batch_date, 'customer' AS file_type,
           'schema mismatch' AS rejection_reason,
           CAST(to_json({'c_custkey': c_custkey, 'c_name': c_name, 'c_nationkey': c_nationkey,
                    'c_mktsegment': CASE WHEN c_acctbal >= 0 THEN c_mktsegment END}) AS VARCHAR) AS raw_record
    FROM customer""")
def quarantine_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "c_name", "c_nationkey",
        "CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS c_mktsegment",
    )
    loaded = datetime(2026, 3, 31, 6, 0, 0)
    kept = quarantine(rows, "main", date(2026, 3, 31), "customer", "schema mismatch", loaded)
    return kept.drop("load_timestamp")


# Upper-casing gives SS for a sharp s; the checking engine leaves that letter alone.
@query(r"""
    SELECT doc_id,
           regexp_replace(regexp_replace(upper(replace(text, 'ß', 'ss')), '[^A-Z\s]', '', 'g'), '^\s+|\s+$', '', 'g')
               AS standardized
    FROM documents""")
def standardize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    return documents.select("doc_id", standardize_name(F.col("text")).alias("standardized"))


# Customers without a balance have no identifier; some have one padded with tabs.
_IDENTIFIER = """CASE WHEN c_acctbal < 0 THEN '  ' WHEN c_acctbal < 1000 THEN NULL
    WHEN c_nationkey = 7 THEN '\t' || c_name || ' ' ELSE c_name END"""
_TRIMMED = f"trim({_IDENTIFIER}, ' \t')"


def customer_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "c_mktsegment", f"{_IDENTIFIER} AS identifier",
        "CAST(c_custkey AS STRING) AS account",
    )


@query(f"""
    SELECT c_custkey, CASE WHEN {_TRIMMED} <> '' THEN sha256({_TRIMMED}) END AS id_hash,
           right(CAST(c_custkey AS STRING), 4) AS account_last_4,
           CASE WHEN length(CAST(c_custkey AS STRING)) > 2
                THEN right(CAST(c_custkey AS STRING), 2) END AS account_last_2
    FROM customer""")
def mask_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    account = F.col("account")
    return customer_identifiers(spark, sf_dir).select(
        "c_custkey",
        hash_identifier(F.col("identifier")).alias("id_hash"),
        last_characters(account).alias("account_last_4"),
        last_characters(account, 2, keep_short=False).alias("account_last_2"),
    )


@query(f"""
    SELECT c_custkey, CASE WHEN {_TRIMMED} <> '' THEN 'SSN' ELSE 'NAME_DOB' END AS method
    FROM customer""", name="match_method")
def matched_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    method = match_method(F.col("identifier"))
    return customer_identifiers(spark, sf_dir).select("c_custkey", method.alias("method"))


@query(f"""
    SELECT c_custkey,
           coalesce(CASE WHEN {_TRIMMED} <> '' THEN sha256({_TRIMMED}) END,
                    c_mktsegment || '_' || CAST(c_custkey AS VARCHAR) || '_NAME_DOB') AS person_key
    FROM customer""", name="business_key")
def person_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    identifier = F.col("identifier")
    fallback = [F.col("c_mktsegment"), F.col("account")]
    key = business_key(hash_identifier(identifier), fallback, match_method(identifier))
    return customer_identifiers(spark, sf_dir).select("c_custkey", key.alias("person_key"))


# The supplier table as a landing file, mapped onto a table of other names and types.
SUPPLIERS = columns(
    supplier_number="STRING NOT NULL",
    batch_date="DATE NOT NULL",
    full_name="STRING",
    country="STRING",
    balance="DECIMAL(12,2)",
    status="STRING",
    load_timestamp="TIMESTAMP NOT NULL",
)
_BATCH, _LOADED = date(2026, 3, 31), datetime(2026, 3, 31, 6, 0, 0)


def _mapped_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = ColumnMapping(
        derived={
            "supplier_number": lambda: F.concat(F.lit("S"), F.col("s_suppkey").cast("string")),
            "full_name": lambda: F.concat_ws(" ", "s_name", F.col("s_nationkey").cast("string")),
            "status": lambda: F.when(F.col("s_acctbal") >= 0, F.lit("ACTIVE")),
        },
        renamed={"s_acctbal": "balance"},
        dropped=("s_suppkey", "s_name", "s_nationkey"),
    )
    return map_columns(read(spark, sf_dir, "supplier"), mapping)


def _time_as_text(df: DataFrame) -> DataFrame:
    return df.withColumn("load_timestamp", F.date_format("load_timestamp", "yyyy-MM-dd HH:mm:ss"))


@query("""
    SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS supplier_number,
           s_name || ' ' || CAST(s_nationkey AS VARCHAR) AS full_name, s_acctbal AS balance,
           CASE WHEN s_acctbal >= 0 THEN 'ACTIVE' END AS status
    FROM supplier""", name="map_columns")
def mapped_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Derive, rename, drop."""
    return _mapped_suppliers(spark, sf_dir)


@query("""
    SELECT *, DATE '2026-03-31' AS batch_date, '2026-03-31 06:00:00' AS load_timestamp
    FROM supplier""", name="audit_columns")
def stamped_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _time_as_text(add_audit(read(spark, sf_dir, "supplier"), _BATCH, _LOADED))


@query("""
    SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS supplier_number, DATE '2026-03-31' AS batch_date,
           s_name || ' ' || CAST(s_nationkey AS VARCHAR) AS full_name, CAST(NULL AS VARCHAR) AS country,
           CAST(s_acctbal AS DECIMAL(12,2)) AS balance,
           CASE WHEN s_acctbal < 0 THEN 'UNKNOWN' ELSE 'ACTIVE' END AS status,
           '2026-03-31 06:00:00' AS load_timestamp
    FROM supplier""", name="conform_columns")
def conformed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target's columns in its order and types; a default for what is missing; NOT NULL kept."""
    stamped = add_audit(_mapped_suppliers(spark, sf_dir), _BATCH, _LOADED)
    return _time_as_text(conform(stamped, SUPPLIERS, {"status": F.lit("UNKNOWN")}))
