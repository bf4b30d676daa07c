"""Landing rows for the policy mart, made from the given tables.

Each file type is a projection of a whole table. Faults are planted by value, so that they
fall on the same rows in any engine. `file_org` and the batch conditions say which file a
row is in; a row may be in both batches, and is then an update, or a repeat.

The expressions are SQL that Spark and the checking engine read alike.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from martloom.plans.policy_mart import CONTRACTS
from martloom.queries.registry import read

ORGS = ("ail", "lnl")
BATCHES = (date(2026, 3, 31), date(2026, 4, 30))
LOADED = {b: datetime(b.year, b.month, b.day, 6, 0, 0) for b in BATCHES}


@dataclass(frozen=True)
class Landing:
    table: str
    columns: dict[str, str]
    file_org: str
    batches: tuple[str, str]

    def rows(self, spark: SparkSession, sf_dir: str, batch: date) -> DataFrame:
        """All files of a batch."""
        rows = read(spark, sf_dir, self.table).where(self.batches[BATCHES.index(batch)])
        columns = [f"{e} AS {n}" for n, e in self.columns.items()]
        return rows.selectExpr(*columns, f"{self.file_org} AS file_org")

    def sql(self, batch: date) -> str:
        """The same as SQL."""
        which = self.batches[BATCHES.index(batch)]
        columns = ", ".join(f"{e} AS {n}" for n, e in self.columns.items())
        return f"SELECT {columns}, {self.file_org} AS file_org FROM {self.table} WHERE {which}"


def _policy(column: str) -> str:
    return f"'P' || lpad(CAST({column} AS STRING), 9, '0')"


def _day(column: str) -> str:
    return f"CAST(CAST({column} AS DATE) AS STRING)"


def _money(column: str) -> str:
    return f"CAST(CAST({column} AS DECIMAL(15,2)) AS STRING)"


_ORDER_ORG = "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'lnl' ELSE 'ail' END"
_ORDER_BATCHES = ("o_orderdate < DATE '1999-01-01'", "o_orderdate >= DATE '1999-01-01'")
_CUSTOMER_ORG = "CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'lnl' ELSE 'ail' END"
_LINE_ORG = "CASE WHEN l_linestatus = 'O' THEN 'lnl' ELSE 'ail' END"

LANDINGS: dict[str, Landing] = {
    # Each order is a notice about its customer's policy: several per batch.
    "basic": Landing(
        table="orders",
        columns={
            "policy_number": _policy("o_custkey"),
            "ssn": "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN ' ' "
            "ELSE CAST(900000000 + o_custkey AS STRING) END",
            "first_name": "CASE WHEN o_totalprice < 10000 THEN '42' ELSE o_orderpriority END",
            "last_name": "'d''Order-' || lower(o_orderstatus)",
            "dob": f"CASE WHEN o_totalprice > 480000 THEN '31/12/1970' ELSE {_day('o_orderdate')} END",
            "gender": "CAST(NULL AS STRING)",
            "policy_type": "'TERM_10'",
            "policy_status": "CASE o_orderstatus WHEN 'F' THEN 'LAPSED' WHEN 'O' THEN 'ACTIVE' "
            "ELSE 'PENDING' END",
            "issue_date": _day("o_orderdate"),
            "face_amount": _money("o_totalprice"),
            "org_code": "CASE WHEN o_totalprice BETWEEN 20000 AND 30000 THEN 'gl' "
            f"ELSE {_ORDER_ORG} END",
        },
        file_org=_ORDER_ORG,
        batches=_ORDER_BATCHES,
    ),
    "address": Landing(
        table="customer",
        columns={
            "policy_number": _policy("c_custkey"),
            "address_type": "CASE WHEN c_mktsegment = 'FURNITURE' THEN 'MAILING' ELSE 'HOME' END",
            "street1": "c_name || ' Street, \"rear\"'",
            "street2": "CAST(NULL AS STRING)",
            "city": "CASE WHEN c_nationkey = 3 THEN '  ' ELSE 'Town ' || c_mktsegment END",
            "state": "'S' || CAST(c_nationkey AS STRING)",
            "zip": "lpad(CAST(c_custkey AS STRING), 5, '0')",
            "effective_date": "'2026-01-01'",
            "org_code": _CUSTOMER_ORG,
        },
        file_org=_CUSTOMER_ORG,
        batches=("c_acctbal < 7000", "c_acctbal >= 3000"),
    ),
    "bankinfo": Landing(
        table="orders",
        columns={
            "policy_number": _policy("o_custkey"),
            "bank_name": "'Bank ' || o_orderpriority",
            "routing_number": "CASE WHEN o_totalprice < 10000 THEN '' "
            "ELSE CAST(110000000 + o_custkey AS STRING) END",
            "account_number": "CAST(o_orderkey AS STRING)",
            "account_type": "CASE WHEN o_orderstatus = 'F' THEN 'SAVINGS' ELSE 'CHECKING' END",
            "effective_date": _day("o_orderdate"),
            "org_code": _ORDER_ORG,
        },
        file_org=_ORDER_ORG,
        batches=_ORDER_BATCHES,
    ),
    # Order and line do not identify a line item: ids repeat, also with other amounts.
    "premiums": Landing(
        table="lineitem",
        columns={
            "policy_number": _policy("l_suppkey"),
            "transaction_id": "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)",
            "premium_date": f"CASE WHEN l_quantity = 50 THEN 'soon' ELSE {_day('l_shipdate')} END",
            "amount": f"CASE WHEN l_quantity = 49 THEN 'n/a' ELSE {_money('l_extendedprice')} END",
            "payment_method": "'EFT'",
            "status": "CASE l_returnflag WHEN 'R' THEN 'RETURNED' WHEN 'A' THEN 'PAID' "
            "ELSE 'PENDING' END",
            "org_code": _LINE_ORG,
        },
        file_org=_LINE_ORG,
        batches=("l_shipdate < DATE '1999-01-01'", "l_shipdate >= DATE '1998-07-01'"),
    ),
}

assert all(list(LANDINGS[t].columns) == c.names for t, c in CONTRACTS.items())
