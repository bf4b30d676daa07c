"""All checks on a finished policy mart, as one table of fault counts."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.operators import quality
from martloom.plans.mart import SCD2_TABLES
from martloom.plans.policy_mart import MART, NATURAL_KEYS

POLICY_KEY = ("policy_number", "org_code")
# Columns the design rules out: facts and dimensions meet on natural keys.
FORBIDDEN = ("policy_key", "premium_key")


def _faults(table: str, check: str, found: DataFrame) -> DataFrame:
    count = found.agg(F.count(F.lit(1)).alias("n_faults"))
    return count.select(F.lit(table).alias("table_name"), F.lit(check).alias("check_name"), "n_faults")


def mart_faults(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, check_name, n_faults) for the tables given; no faults is 0."""
    found = []
    for name, df in tables.items():
        keys = NATURAL_KEYS[name]
        if name in SCD2_TABLES:
            spec = SCD2_TABLES[name]
            found.append(_faults(name, "multiple_current", quality.multiple_current(df, spec)))
            found.append(_faults(name, "interval", quality.interval_faults(df, spec)))
        else:
            found.append(_faults(name, "duplicate_key", quality.duplicate_keys(df, keys)))
        report = quality.column_report(df, MART[name].schema, FORBIDDEN)
        found.append(_faults(name, "column", report.where(~F.col("status").isin("ok", "extra"))))
    if "fact_premiums" in tables:
        facts = tables["fact_premiums"]
        if "dim_policy" in tables:
            lost = quality.orphans(facts, tables["dim_policy"], POLICY_KEY)
            found.append(_faults("fact_premiums", "orphan_policy", lost))
        if "dim_organization" in tables:
            unknown = quality.outside_domain(
                facts, "org_code", tables["dim_organization"], "org_code"
            )
            found.append(_faults("fact_premiums", "unknown_org", unknown))
    return reduce(DataFrame.unionByName, found)
