"""The policy mart's contracts, mappings, tables and merge rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from martloom.functions import hash_identifier, last_characters
from martloom.operators.mapping import ColumnMapping
from martloom.operators.merge import Scd1, Scd2
from martloom.operators.schema import columns
from martloom.sources.contract import Contract, ContractColumn
from martloom.sources.tables import Table


def _contract(
    file_type: str,
    names: tuple[str, ...],
    unchecked: tuple[str, ...] = (),
    dates: tuple[str, ...] = (),
    decimals: tuple[str, ...] = (),
    pii: tuple[str, ...] = (),
    **more,
) -> Contract:
    kinds = dict.fromkeys(dates, "date") | dict.fromkeys(decimals, "decimal")
    return Contract(
        org="",
        file_type=file_type,
        columns=tuple(
            ContractColumn(n, kinds.get(n, "string"), nullable=n in unchecked, pii=n in pii)
            for n in names
        ),
        not_null=tuple(n for n in names if n not in unchecked),
        **more,
    )


# The landing files. All organisations share them.
CONTRACTS: dict[str, Contract] = {
    c.file_type: c
    for c in (
        _contract(
            "basic",
            (
                "policy_number", "ssn", "first_name", "last_name", "dob", "gender", "policy_type",
                "policy_status", "issue_date", "face_amount", "org_code",
            ),
            unchecked=("ssn", "gender"),
            dates=("dob", "issue_date"),
            decimals=("face_amount",),
            pii=("ssn",),
            id_field="ssn",
            match_fallback=("first_name", "last_name", "dob"),
        ),
        _contract(
            "address",
            (
                "policy_number", "address_type", "street1", "street2", "city", "state", "zip",
                "effective_date", "org_code",
            ),
            unchecked=("street2",),
            dates=("effective_date",),
        ),
        _contract(
            "bankinfo",
            (
                "policy_number", "bank_name", "routing_number", "account_number", "account_type",
                "effective_date", "org_code",
            ),
            dates=("effective_date",),
            pii=("account_number",),
        ),
        _contract(
            "premiums",
            (
                "policy_number", "transaction_id", "premium_date", "amount", "payment_method",
                "status", "org_code",
            ),
            dates=("premium_date",),
            decimals=("amount",),
        ),
    )
}

# Columns that hide raw values. Applied before rows are split, so rejects are masked too.
MASKS: dict[str, ColumnMapping] = {
    "bankinfo": ColumnMapping(
        derived={
            "account_number_last_4": lambda: last_characters(F.col("account_number")),
            "routing_number_hash": lambda: hash_identifier(F.col("routing_number")),
        },
        dropped=("account_number", "routing_number"),
    ),
}

# Landing columns to staging columns.
MAPPINGS: dict[str, ColumnMapping] = {
    "basic": ColumnMapping(
        derived={
            "policyholder_name": lambda: F.concat_ws(" ", F.col("first_name"), F.col("last_name"))
        },
        # The staging column named effective_date holds the date of birth.
        renamed={"dob": "effective_date"},
        dropped=("first_name", "last_name", "face_amount", "policy_type", "gender"),
    ),
    "address": ColumnMapping(
        derived={"country": lambda: F.lit(None).cast("string")},
        renamed={"street1": "street_address", "zip": "zip_code"},
        dropped=("street2", "effective_date"),
    ),
    "bankinfo": ColumnMapping(
        renamed={"account_type": "payment_method_type"}, dropped=("effective_date",)
    ),
    "premiums": ColumnMapping(
        renamed={
            "premium_date": "transaction_date",
            "amount": "premium_amount",
            "status": "payment_status",
        },
        dropped=("payment_method",),
    ),
}


# The tables, in their column order.
STAGING: dict[str, Table] = {
    t.name.removeprefix("stg_"): t
    for t in (
        Table(
            "stg_basic",
            columns(
                org_code="STRING NOT NULL",
                batch_date="DATE NOT NULL",
                policy_number="STRING NOT NULL",
                policyholder_name="STRING",
                ssn_hash="STRING",
                match_method="STRING",
                policy_status="STRING",
                issue_date="DATE",
                effective_date="DATE",
                load_timestamp="TIMESTAMP NOT NULL",
            ),
            ("org_code", "batch_date"),
        ),
        Table(
            "stg_address",
            columns(
                org_code="STRING NOT NULL",
                batch_date="DATE NOT NULL",
                policy_number="STRING NOT NULL",
                address_type="STRING NOT NULL",
                street_address="STRING",
                city="STRING",
                state="STRING",
                zip_code="STRING",
                country="STRING",
                load_timestamp="TIMESTAMP NOT NULL",
            ),
            ("org_code", "batch_date"),
        ),
        Table(
            "stg_bankinfo",
            columns(
                org_code="STRING NOT NULL",
                batch_date="DATE NOT NULL",
                policy_number="STRING NOT NULL",
                payment_method_type="STRING",
                account_number_last_4="STRING",
                bank_name="STRING",
                routing_number_hash="STRING",
                load_timestamp="TIMESTAMP NOT NULL",
            ),
            ("org_code", "batch_date"),
        ),
        Table(
            "stg_premiums",
            columns(
                org_code="STRING NOT NULL",
                batch_date="DATE NOT NULL",
                transaction_id="STRING NOT NULL",
                policy_number="STRING NOT NULL",
                premium_amount="DECIMAL(12,2)",
                transaction_date="DATE",
                payment_status="STRING",
                load_timestamp="TIMESTAMP NOT NULL",
            ),
            ("org_code", "batch_date"),
        ),
        Table(
            "stg_rejected",
            columns(
                org_code="STRING NOT NULL",
                batch_date="DATE NOT NULL",
                file_type="STRING NOT NULL",
                rejection_reason="STRING",
                raw_record="STRING NOT NULL",
                load_timestamp="TIMESTAMP NOT NULL",
            ),
            ("org_code", "batch_date", "file_type"),
        ),
    )
}

MART: dict[str, Table] = {
    t.name: t
    for t in (
        Table(
            "dim_organization",
            columns(
                org_key="INT NOT NULL",
                org_code="STRING NOT NULL",
                org_name="STRING",
                org_type="STRING",
                active_flag="BOOLEAN",
                created_date="DATE NOT NULL",
                updated_date="DATE NOT NULL",
            ),
        ),
        Table(
            "dim_policyholder",
            columns(
                policyholder_business_key="STRING NOT NULL",
                org_code="STRING NOT NULL",
                policyholder_name="STRING",
                ssn_hash="STRING",
                dob_hash="STRING",
                is_current="BOOLEAN NOT NULL",
                effective_date="DATE NOT NULL",
                end_date="DATE",
                created_date="DATE NOT NULL",
                updated_date="DATE NOT NULL",
            ),
            ("org_code",),
        ),
        Table(
            "dim_policy",
            columns(
                policy_number="STRING NOT NULL",
                org_code="STRING NOT NULL",
                policy_status="STRING",
                issue_date="DATE",
                effective_date="DATE",
                termination_date="DATE",
                is_current="BOOLEAN NOT NULL",
                effective_date_scd="DATE NOT NULL",
                end_date_scd="DATE",
                created_date="DATE NOT NULL",
                updated_date="DATE NOT NULL",
            ),
            ("org_code",),
        ),
        Table(
            "dim_address",
            columns(
                policy_number="STRING NOT NULL",
                org_code="STRING NOT NULL",
                address_type="STRING NOT NULL",
                street_address="STRING",
                city="STRING",
                state="STRING",
                zip_code="STRING",
                country="STRING",
                is_current="BOOLEAN NOT NULL",
                created_date="DATE NOT NULL",
                updated_date="DATE NOT NULL",
            ),
            ("org_code",),
        ),
        Table(
            "dim_payment_method",
            columns(
                policy_number="STRING NOT NULL",
                org_code="STRING NOT NULL",
                payment_method_type="STRING",
                account_number_last_4="STRING",
                bank_name="STRING",
                is_current="BOOLEAN NOT NULL",
                created_date="DATE NOT NULL",
                updated_date="DATE NOT NULL",
            ),
            ("org_code",),
        ),
        Table(
            "fact_premiums",
            columns(
                transaction_id="STRING NOT NULL",
                policy_number="STRING NOT NULL",
                org_code="STRING NOT NULL",
                premium_amount="DECIMAL(12,2)",
                transaction_date="DATE",
                payment_status="STRING",
                created_date="DATE NOT NULL",
                batch_date="DATE NOT NULL",
            ),
            ("org_code", "batch_date"),
        ),
    )
}

# The reference table of organisations.
ORGANIZATIONS = (
    (1, "ail", "American Income Life", "subsidiary", True),
    (2, "gl", "Globe Life", "subsidiary", True),
    (3, "lnl", "Liberty National Life", "subsidiary", True),
    (4, "ua", "United American Insurance", "subsidiary", True),
)
ORG_CODES = tuple(row[1] for row in ORGANIZATIONS)

# Merge rules, by natural key.
POLICYHOLDER = Scd2(
    keys=("policyholder_business_key", "org_code"), tracked=("policyholder_name", "ssn_hash")
)
POLICY = Scd2(
    keys=("policy_number", "org_code"),
    tracked=("policy_status", "issue_date"),
    start="effective_date_scd",
    end="end_date_scd",
)
ADDRESS = Scd1(
    keys=("policy_number", "org_code", "address_type"),
    attributes=("street_address", "city", "state", "zip_code", "country"),
)
PAYMENT_METHOD = Scd1(
    keys=("policy_number", "org_code"),
    attributes=("payment_method_type", "account_number_last_4", "bank_name"),
)
PREMIUM_KEY = ("transaction_id",)

NATURAL_KEYS: dict[str, tuple[str, ...]] = {
    "dim_organization": ("org_code",),
    "dim_policyholder": POLICYHOLDER.keys,
    "dim_policy": POLICY.keys,
    "dim_address": ADDRESS.keys,
    "dim_payment_method": PAYMENT_METHOD.keys,
    "fact_premiums": PREMIUM_KEY,
}
