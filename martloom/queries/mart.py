"""The policy mart after two batches of two organisations, table by table and as files."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.operators.quality import fact_dim_join
from martloom.operators.validate import REASON
from martloom.plans.checks import mart_faults
from martloom.plans.mart import (
    merge_addresses,
    merge_payment_methods,
    merge_policies,
    merge_policyholders,
    new_premiums,
    read_mart,
    seed_organizations,
)
from martloom.plans.pipeline import run_batch, side_by_side
from martloom.plans.policy_mart import CONTRACTS, MART
from martloom.plans.staging import stage
from martloom.queries.landing import BATCHES, LANDINGS, LOADED, ORGS
from martloom.queries.registry import query
from martloom.sources.scratch import scratch_dir, stored
from martloom.sources.tables import empty_rows

# --- the same mart as SQL

_FILLED = {
    file_type: [f"WHEN {n} IS NULL OR trim({n}) = '' THEN 'null_or_empty: {n}'" for n in c.not_null]
    for file_type, c in CONTRACTS.items()
}


def checked_sql(file_type: str, batch: date) -> str:
    """Landing rows with their rejection reason."""
    contract = CONTRACTS[file_type]
    rows = LANDINGS[file_type].sql(batch)
    if file_type == "basic":
        names = ", ".join(
            rf"trim(regexp_replace(upper({n}), '[^A-Z\s]', '', 'g')) AS {n}"
            for n in ("first_name", "last_name")
        )
        rows = f"SELECT * REPLACE ({names}) FROM ({rows})"
    dates = [
        rf"WHEN NOT regexp_full_match({c.name}, '\d{{4}}-\d{{2}}-\d{{2}}') "
        f"THEN 'invalid_date_format: {c.name}'"
        for c in contract.of_type("date")
    ]
    types = {"face_amount": "DECIMAL(15,2)", "amount": "DECIMAL(12,2)"}
    dates += [
        f"WHEN TRY_CAST({c.name} AS DATE) IS NULL THEN 'invalid_date: {c.name}'"
        for c in contract.of_type("date")
    ]
    dates += [
        f"WHEN TRY_CAST({c.name} AS {types[c.name]}) IS NULL THEN 'invalid_decimal: {c.name}'"
        for c in contract.of_type("decimal")
    ]
    org = ["WHEN org_code <> file_org THEN 'org_code mismatch: expected ' || file_org"]
    checks = " ".join([*_FILLED[file_type], *org, *dates])
    return f"SELECT *, CASE {checks} END AS rejection_reason FROM ({rows})"


def _valid(file_type: str, batch: date) -> str:
    return f"SELECT * FROM ({checked_sql(file_type, batch)}) WHERE rejection_reason IS NULL"


def _scd2_sql(old: str, new: str, keys: list[str], tracked: list[str], start: str, end: str) -> str:
    """Two batches, each one row per key, as a dimension."""
    on = " AND ".join(f"a.{k} = b.{k}" for k in keys)
    differs = " OR ".join(f"a.{c} IS DISTINCT FROM b.{c}" for c in tracked)
    first, second = BATCHES
    return f"""
        WITH a AS ({old}), b AS ({new})
        SELECT a.*, NOT (b.{keys[0]} IS NOT NULL AND ({differs})) AS is_current,
               DATE '{first}' AS {start},
               CASE WHEN b.{keys[0]} IS NOT NULL AND ({differs})
                    THEN DATE '{second}' - INTERVAL 1 DAY END :: DATE AS {end},
               DATE '{first}' AS created_date,
               CASE WHEN b.{keys[0]} IS NOT NULL AND ({differs})
                    THEN DATE '{second}' ELSE DATE '{first}' END AS updated_date
        FROM a LEFT JOIN b ON {on}
        UNION ALL
        SELECT b.*, TRUE, DATE '{second}', NULL, DATE '{second}', DATE '{second}'
        FROM b LEFT JOIN a ON {on}
        WHERE a.{keys[0]} IS NULL OR {differs}"""


def _policyholders(batch: date) -> str:
    return f"""
        SELECT policyholder_business_key, org_code, policyholder_name, ssn_hash,
               CAST(NULL AS VARCHAR) AS dob_hash
        FROM (SELECT *, coalesce(ssn_hash, policyholder_name || '_' || match_method)
                        AS policyholder_business_key
              FROM (SELECT org_code, first_name || ' ' || last_name AS policyholder_name, dob,
                           CASE WHEN trim(ssn) <> '' THEN sha256(trim(ssn)) END AS ssn_hash,
                           CASE WHEN trim(ssn) <> '' THEN 'SSN' ELSE 'NAME_DOB' END AS match_method
                    FROM ({_valid("basic", batch)})))
        QUALIFY row_number() OVER (PARTITION BY policyholder_business_key, org_code
                                   ORDER BY dob DESC, policyholder_name DESC) = 1"""


def _policies(batch: date) -> str:
    return f"""
        SELECT policy_number, org_code, policy_status, CAST(issue_date AS DATE) AS issue_date,
               CAST(dob AS DATE) AS effective_date, CAST(NULL AS DATE) AS termination_date
        FROM ({_valid("basic", batch)})
        QUALIFY row_number() OVER (PARTITION BY policy_number, org_code
                                   ORDER BY issue_date DESC, policy_status DESC, dob DESC) = 1"""


def _scd1_sql(old: str, new: str, keys: list[str], attributes: list[str]) -> str:
    on = " AND ".join(f"a.{k} = b.{k}" for k in keys)
    picked = [f"CASE WHEN b.{keys[0]} IS NULL THEN a.{c} ELSE b.{c} END AS {c}" for c in keys + attributes]
    first, second = BATCHES
    return f"""
        WITH a AS ({old}), b AS ({new})
        SELECT {", ".join(picked)}, TRUE AS is_current,
               CASE WHEN a.{keys[0]} IS NULL THEN DATE '{second}' ELSE DATE '{first}' END AS created_date,
               CASE WHEN b.{keys[0]} IS NULL THEN DATE '{first}' ELSE DATE '{second}' END AS updated_date
        FROM a FULL JOIN b ON {on}"""


def _addresses(batch: date) -> str:
    return f"""
        SELECT policy_number, org_code, address_type, street1 AS street_address, city, state,
               zip AS zip_code, CAST(NULL AS VARCHAR) AS country
        FROM ({_valid("address", batch)})"""


def _payments(batch: date) -> str:
    return f"""
        SELECT policy_number, org_code, account_type AS payment_method_type,
               right(account_number, 4) AS account_number_last_4, bank_name
        FROM ({_valid("bankinfo", batch)})
        QUALIFY row_number() OVER (PARTITION BY policy_number, org_code
                                   ORDER BY account_type DESC, right(account_number, 4) DESC,
                                            bank_name DESC) = 1"""


def _premiums(batch: date) -> str:
    return f"""
        SELECT DISTINCT transaction_id, policy_number, org_code,
               TRY_CAST(amount AS DECIMAL(12,2)) AS premium_amount,
               CAST(premium_date AS DATE) AS transaction_date, status AS payment_status,
               DATE '{batch}' AS created_date, DATE '{batch}' AS batch_date
        FROM ({_valid("premiums", batch)})"""


POLICYHOLDERS_SQL = _scd2_sql(
    _policyholders(BATCHES[0]), _policyholders(BATCHES[1]),
    ["policyholder_business_key", "org_code"], ["policyholder_name", "ssn_hash"],
    "effective_date", "end_date",
)
POLICIES_SQL = _scd2_sql(
    _policies(BATCHES[0]), _policies(BATCHES[1]),
    ["policy_number", "org_code"], ["policy_status", "issue_date"],
    "effective_date_scd", "end_date_scd",
)
ADDRESSES_SQL = _scd1_sql(
    _addresses(BATCHES[0]), _addresses(BATCHES[1]),
    ["policy_number", "org_code", "address_type"],
    ["street_address", "city", "state", "zip_code", "country"],
)
PAYMENTS_SQL = _scd1_sql(
    _payments(BATCHES[0]), _payments(BATCHES[1]),
    ["policy_number", "org_code"], ["payment_method_type", "account_number_last_4", "bank_name"],
)
PREMIUMS_SQL = f"""
    SELECT * FROM ({_premiums(BATCHES[0])})
    UNION ALL
    SELECT * FROM ({_premiums(BATCHES[1])})
    WHERE transaction_id NOT IN (SELECT transaction_id FROM ({_premiums(BATCHES[0])}))"""


# --- the mart with the operators


def staged(spark: SparkSession, sf_dir: str, file_type: str, batch: date) -> tuple[DataFrame, DataFrame]:
    """(staging rows, rejects) of all organisations' files, in one pass."""
    rows = LANDINGS[file_type].rows(spark, sf_dir, batch)
    file_org = F.col("file_org")
    return stage(rows, CONTRACTS[file_type], batch, LOADED[batch], expected_org=file_org)


def _two_batches(
    spark: SparkSession, sf_dir: str, name: str, file_type: str, merge: Callable
) -> DataFrame:
    """Merge both batches. Staging rows are written before a merge, and the table after the first."""
    table = empty_rows(spark, MART[name].schema)
    for batch in BATCHES:
        rows, _ = staged(spark, sf_dir, file_type, batch)
        table = merge(table, stored(rows), batch)
        if batch != BATCHES[-1]:
            table = stored(table)
    return table


@query(POLICYHOLDERS_SQL)
def mart_policyholder(spark: SparkSession, sf_dir: str) -> DataFrame:
    def merge(dim: DataFrame, rows: DataFrame, batch: date) -> DataFrame:
        current, closed = dim.where("is_current"), dim.where("NOT is_current")
        return merge_policyholders(current, rows, batch, batch).unionByName(closed)

    return _two_batches(spark, sf_dir, "dim_policyholder", "basic", merge)


@query(POLICIES_SQL)
def mart_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    def merge(dim: DataFrame, rows: DataFrame, batch: date) -> DataFrame:
        current, closed = dim.where("is_current"), dim.where("NOT is_current")
        return merge_policies(current, rows, batch, batch).unionByName(closed)

    return _two_batches(spark, sf_dir, "dim_policy", "basic", merge)


@query(ADDRESSES_SQL)
def mart_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_batches(spark, sf_dir, "dim_address", "address", merge_addresses)


@query(PAYMENTS_SQL)
def mart_payment_method(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_batches(spark, sf_dir, "dim_payment_method", "bankinfo", merge_payment_methods)


@query(PREMIUMS_SQL)
def mart_premiums(spark: SparkSession, sf_dir: str) -> DataFrame:
    def merge(facts: DataFrame, rows: DataFrame, batch: date) -> DataFrame:
        return facts.unionByName(new_premiums(facts, rows, batch, batch))

    return _two_batches(spark, sf_dir, "fact_premiums", "premiums", merge)


_REJECTS_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS file_type, DATE '{b}' AS batch_date, rejection_reason, count(*) AS n_rows "
    f"FROM ({checked_sql(t, b)}) WHERE rejection_reason IS NOT NULL GROUP BY ALL"
    for t in CONTRACTS
    for b in BATCHES
)


@query(_REJECTS_SQL)
def mart_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = []
    for file_type in CONTRACTS:
        for batch in BATCHES:
            _, rejected = staged(spark, sf_dir, file_type, batch)
            parts.append(rejected.select(F.lit(file_type).alias("file_type"), "batch_date", REASON))
    rejects = parts[0]
    for part in parts[1:]:
        rejects = rejects.unionByName(part)
    return rejects.groupBy("file_type", "batch_date", REASON).agg(F.count(F.lit(1)).alias("n_rows"))


@query(f"""
    SELECT f.transaction_id, f.policy_number, f.org_code, f.premium_amount, f.transaction_date,
           f.payment_status, f.created_date, f.batch_date, p.policy_status, p.issue_date,
           p.effective_date_scd, m.payment_method_type, m.account_number_last_4, m.bank_name
    FROM ({PREMIUMS_SQL}) f
    JOIN (SELECT * FROM ({POLICIES_SQL}) WHERE is_current) p
      ON f.policy_number = p.policy_number AND f.org_code = p.org_code
    JOIN ({PAYMENTS_SQL}) m ON f.policy_number = m.policy_number AND f.org_code = m.org_code""")
def pipeline_two_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing files written, loaded and transformed for both batches; then the mart read."""
    root = scratch_dir(spark, "pipeline")
    for batch in BATCHES:
        paths = {file_type: f"{root}/landing/{batch}/{file_type}" for file_type in LANDINGS}

        def land(file_type: str, batch: date = batch, paths: dict[str, str] = paths) -> None:
            rows = LANDINGS[file_type].rows(spark, sf_dir, batch)
            rows.write.partitionBy("file_org").option("header", True).csv(paths[file_type])

        side_by_side(lambda file_type=file_type: land(file_type) for file_type in LANDINGS)
        files = {(org, t): f"{path}/file_org={org}" for t, path in paths.items() for org in ORGS}
        run_batch(spark, files, f"{root}/staging", f"{root}/mart", batch, LOADED[batch])

    def table(name: str) -> DataFrame:
        return read_mart(spark, name, f"{root}/mart")

    keys = ["policy_number", "org_code"]
    facts = table("fact_premiums")
    with_policy = fact_dim_join(
        facts, table("dim_policy"), keys,
        ["policy_status", "issue_date", "effective_date_scd"],
    )
    return fact_dim_join(
        with_policy, table("dim_payment_method"), keys,
        ["payment_method_type", "account_number_last_4", "bank_name"], counted_in=facts,
    )


_FAULTS_SQL = f"""
    WITH p AS ({POLICIES_SQL}), h AS ({POLICYHOLDERS_SQL}), m AS ({PAYMENTS_SQL}), f AS ({PREMIUMS_SQL}), a AS ({ADDRESSES_SQL})
    SELECT 'fact_premiums' AS table_name, 'duplicate_key' AS check_name, count(*) AS n_faults
    FROM (SELECT transaction_id FROM f GROUP BY ALL HAVING count(*) > 1)
    UNION ALL SELECT 'fact_premiums', 'orphan_policy', count(*)
    FROM (SELECT DISTINCT policy_number, org_code FROM f ANTI JOIN p USING (policy_number, org_code))
    UNION ALL SELECT 'fact_premiums', 'unknown_org', count(*)
    FROM (SELECT DISTINCT org_code FROM f WHERE org_code NOT IN ('ail', 'gl', 'lnl', 'ua'))
    UNION ALL SELECT 'dim_organization', 'duplicate_key', 0
    UNION ALL SELECT 'dim_organization', 'column', 0
    UNION ALL SELECT 'dim_address', 'duplicate_key', count(*)
    FROM (SELECT 1 FROM a GROUP BY policy_number, org_code, address_type HAVING count(*) > 1)
    UNION ALL SELECT 'dim_address', 'column', 0
    UNION ALL SELECT 'fact_premiums', 'column', 0
    UNION ALL SELECT 'dim_payment_method', 'duplicate_key', count(*)
    FROM (SELECT policy_number FROM m GROUP BY policy_number, org_code HAVING count(*) > 1)
    UNION ALL SELECT 'dim_payment_method', 'column', 0
    UNION ALL SELECT 'dim_policy', 'multiple_current', count(*)
    FROM (SELECT policy_number FROM p WHERE is_current GROUP BY policy_number, org_code HAVING count(*) > 1)
    UNION ALL SELECT 'dim_policy', 'interval', count(*)
    FROM (SELECT *, lead(effective_date_scd) OVER (PARTITION BY policy_number, org_code
                                                   ORDER BY effective_date_scd) AS next_start FROM p)
    WHERE end_date_scd < effective_date_scd OR next_start IS DISTINCT FROM end_date_scd + INTERVAL 1 DAY
    UNION ALL SELECT 'dim_policy', 'column', 0
    UNION ALL SELECT 'dim_policyholder', 'multiple_current', count(*)
    FROM (SELECT 1 FROM h WHERE is_current GROUP BY policyholder_business_key, org_code HAVING count(*) > 1)
    UNION ALL SELECT 'dim_policyholder', 'interval', count(*)
    FROM (SELECT *, lead(effective_date) OVER (PARTITION BY policyholder_business_key, org_code
                                               ORDER BY effective_date) AS next_start FROM h)
    WHERE end_date < effective_date OR next_start IS DISTINCT FROM end_date + INTERVAL 1 DAY
    UNION ALL SELECT 'dim_policyholder', 'column', 0"""


@query(_FAULTS_SQL)
def mart_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every check on the mart. Premium ids repeat in the given data, and some premiums have no policy."""
    made = {
        "fact_premiums": mart_premiums,
        "dim_payment_method": mart_payment_method,
        "dim_address": mart_address,
        "dim_policy": mart_policy,
        "dim_policyholder": mart_policyholder,
    }
    tables = side_by_side(lambda make=make: stored(make(spark, sf_dir)) for make in made.values())
    root = scratch_dir(spark, "mart")
    seed_organizations(spark, root, BATCHES[0])
    organizations = {"dim_organization": read_mart(spark, "dim_organization", root)}
    return mart_faults(dict(zip(made, tables)) | organizations)
