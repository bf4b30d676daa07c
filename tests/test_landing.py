"""Contracts, scans, checks and the valid/reject split."""

import json
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martloom.operators.mapping import typed_cast
from martloom.operators.schema import MissingColumns, columns, conform, schema_diff
from martloom.operators.validate import REASON, all_reasons, row_checks, split, validate
from martloom.plans.policy_mart import CONTRACTS
from martloom.plans.staging import stage
from martloom.sources.contract import MALFORMED, load_contract, parse_contract
from martloom.sources.delimited import scan_delimited

DOC = {
    "org": "ail",
    "file_type": "things",
    "columns": [
        {"name": "id", "type": "string", "nullable": False},
        {"name": "first_name"},
        {"name": "day", "type": "date", "format": "YYYY-MM-DD"},
        {"name": "amount", "type": "decimal"},
        {"name": "org_code"},
    ],
    "not_null_check": ["id", "first_name", "day", "org_code"],
}
CONTRACT = parse_contract(DOC)
BATCH, LOADED = date(2026, 3, 31), datetime(2026, 3, 31, 6, 0)


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def rows_of(spark, *rows):
    return spark.createDataFrame(rows, "id string, first_name string, day string, amount string, org_code string")


def reasons(spark, *rows, strict=False):
    return [r[REASON] for r in validate(rows_of(spark, *rows), CONTRACT, strict=strict).collect()]


def test_contract_document(spark, tmp_path):
    path = write(tmp_path / "c.json", json.dumps(DOC | {"ssn_field": "id", "pii_fields": ["id"]}, indent=2))
    contract = load_contract(spark, path)
    assert contract.names == ["id", "first_name", "day", "amount", "org_code"]
    assert contract.delimiter == "," and contract.id_field == "id"
    assert [c.name for c in contract.columns if c.pii] == ["id"]
    assert contract.columns[2].date_shape == r"\d{4}\-\d{2}\-\d{2}"
    assert contract.columns[2].date_pattern == "yyyy-MM-dd"


def test_contract_faults():
    with pytest.raises(ValueError, match="unknown column types"):
        parse_contract(DOC | {"columns": [{"name": "a", "type": "datetime"}], "not_null_check": []})
    with pytest.raises(ValueError, match="undeclared"):
        parse_contract(DOC | {"not_null_check": ["nothing"]})


def test_shipped_contracts_cover_four_files():
    assert set(CONTRACTS) == {"basic", "address", "bankinfo", "premiums"}
    assert "ssn" not in CONTRACTS["basic"].not_null and "street2" not in CONTRACTS["address"].not_null


def test_scan_finds_columns_by_header(spark, tmp_path):
    path = write(
        tmp_path / "a.csv",
        'org_code,extra,day,id,first_name,amount\nail,zzz,2026-01-01,1,"A, ""B""",\nail,,"", ,,2\n',
    )
    rows = [tuple(r) for r in scan_delimited(spark, path, CONTRACT).collect()]
    # Spark unescapes quotes by backslash. Empty fields, quoted or not, are NULL; a space stays.
    assert rows[0][0] == "1" and rows[0][2:] == ("2026-01-01", None, "ail")
    assert rows[1] == (" ", None, None, "2", "ail")


def test_scan_needs_every_column(spark, tmp_path):
    path = write(tmp_path / "a.csv", "id,first_name\n1,A\n")
    with pytest.raises(MissingColumns, match="day"):
        scan_delimited(spark, path, CONTRACT)


def test_malformed_rows_are_flagged(spark, tmp_path):
    head = "id,first_name,day,amount,org_code"
    path = write(tmp_path / "a.csv", f"{head}\n1,A,2026-01-01,1,ail\n2,B\n3,C,2026-01-01,1,ail,tail\n")
    flagged = scan_delimited(spark, path, CONTRACT, flag_malformed=True, source_file=True)
    assert [(r["id"], r[MALFORMED]) for r in flagged.orderBy("id").collect()] == [
        ("1", False), ("2", True), ("3", True),
    ]
    assert flagged.first()["source_file"].endswith("a.csv")
    judged = validate(flagged.drop("source_file"), CONTRACT, strict=True).orderBy("id")
    assert [r[REASON] for r in judged.collect()] == [None, "malformed_row", "malformed_row"]
    # Without the flag a short row is filled with NULLs, and a long one loses its tail.
    plain = validate(scan_delimited(spark, path, CONTRACT), CONTRACT).orderBy("id")
    assert [r[REASON] for r in plain.collect()] == [None, "null_or_empty: day", None]


def test_first_reason_precedence(spark):
    assert reasons(
        spark,
        ("1", "A", "2026-01-01", "1", "ail"),
        (" ", "A", "01/02/2026", "1", "lnl"),
        ("1", "A", "01/02/2026", "1", "lnl"),
        ("1", "A", "01/02/2026", "1", "ail"),
        ("1", "A", "2026-99-99", "x", "ail"),
        ("1", "A", " 2026-01-01", "1", "ail"),
        ("1", "A", "2026-01-01", "1", None),
        ("1", "123", "2026-01-01", "1", "ail"),
        ("\t", "A", "2026-01-01", "1", "ail"),
    ) == [
        None,
        "null_or_empty: id",
        "org_code mismatch: expected ail",
        "invalid_date_format: day",
        None,
        "invalid_date_format: day",
        "null_or_empty: org_code",
        "null_or_empty: first_name",
        "null_or_empty: id",
    ]


def test_strict_reasons(spark):
    assert reasons(
        spark,
        ("1", "A", "2026-02-30", "1", "ail"),
        ("1", "A", "2026-02-28", "one", "ail"),
        ("1", "A", "2026-02-28", "99999999999999999", "ail"),
        ("1", "A", "2026-02-28", None, "ail"),
        strict=True,
    ) == ["invalid_date: day", "invalid_decimal: amount", "invalid_decimal: amount", None]


def test_all_reasons(spark):
    df = rows_of(spark, (None, "A", "x", "y", "lnl"))
    [row] = df.select(all_reasons(row_checks(CONTRACT, strict=True)).alias("r")).collect()
    assert row.r == [
        "null_or_empty: id", "org_code mismatch: expected ail", "invalid_date_format: day",
        "invalid_date: day", "invalid_decimal: amount",
    ]


def test_split_is_a_partition(spark):
    df = rows_of(spark, *[(str(i) if i % 3 else None, "A", "2026-01-01", "1", "ail") for i in range(30)])
    valid, rejected = split(validate(df, CONTRACT))
    assert valid.count() == 20 and rejected.count() == 10
    assert REASON not in valid.columns


def test_typed_cast_never_fails(spark):
    df = rows_of(
        spark, ("1", "A", "2026-02-30", "n/a", "x"), ("2", "B", "2026-02-28", " 1.005 ", "x"),
        ("3", "C", None, None, "x"),
    )
    rows = [(r.day, r.amount) for r in typed_cast(df, CONTRACT).orderBy("id").collect()]
    assert rows == [(None, None), (date(2026, 2, 28), Decimal("1.01")), (None, None)]


def test_rejected_bank_rows_are_masked(spark):
    contract = CONTRACTS["bankinfo"].for_org("ail")
    df = spark.createDataFrame(
        [("P1", "Bank", "111", "12345678", "SAVINGS", "2026-01-01", "ail"),
         ("P2", None, "222", "87654321", "SAVINGS", "2026-01-01", "ail")],
        ", ".join(f"{n} string" for n in contract.names),
    )
    valid, rejected = stage(df, contract, BATCH, LOADED)
    assert valid.first()["account_number_last_4"] == "5678"
    [row] = rejected.collect()
    assert row[REASON] == "null_or_empty: bank_name" and row["account_number_last_4"] == "4321"
    assert not {"account_number", "routing_number"} & set(rejected.columns)
    assert "87654321" not in str(row) and "222" not in [row["routing_number_hash"]]


def test_basic_rows_reach_their_table(spark):
    contract = CONTRACTS["basic"].for_org("ail")
    df = spark.createDataFrame(
        [("P1", " 123-45-6789 ", "Ann-Marie", "o'Neil", "1970-01-02", None, "TERM_10", "ACTIVE",
          "2020-05-06", "100000.00", "ail"),
         ("P2", "\t", "Bo", "Li", "1980-01-02", "M", "TERM_10", "ACTIVE", "2020-05-06", "1", "ail")],
        ", ".join(f"{n} string" for n in contract.names),
    )
    valid, _ = stage(df, contract, BATCH, LOADED)
    first, second = valid.orderBy("policy_number").collect()
    assert first.policyholder_name == "ANNMARIE ONEIL"
    assert first.match_method == "SSN" and len(first.ssn_hash) == 64
    assert first.effective_date == date(1970, 1, 2) and first.issue_date == date(2020, 5, 6)
    assert (second.match_method, second.ssn_hash) == ("NAME_DOB", None)
    assert first.load_timestamp == LOADED


def test_conform(spark):
    target = columns(a="STRING NOT NULL", b="DECIMAL(12,2)", c="STRING", d="BOOLEAN")
    df = spark.createDataFrame([("1.239", "x", 1)], "b string, a string, z int")
    [row] = conform(df, target, {"d": F.lit(True)}).collect()
    assert tuple(row) == ("x", Decimal("1.24"), None, True)
    with pytest.raises(MissingColumns):
        conform(df.drop("a"), target)
    with pytest.raises(Exception, match="NULL in a"):
        conform(df.withColumn("a", F.lit(None)), target).collect()
    too_big = spark.sql("SELECT 'x' AS a, CAST('99999999999.00' AS DECIMAL(15,2)) AS b")
    with pytest.raises(Exception, match="does not fit b"):
        conform(too_big, target).collect()


def test_schema_diff():
    have = columns(a="STRING", b="INT", x="DATE")
    diff = schema_diff(have, columns(a="STRING", b="BIGINT", c="DATE"))
    assert (diff.missing, diff.unexpected, diff.retyped) == (("c",), ("x",), ("b",))
    assert str(diff) == "missing: c; unexpected: x; retyped: b"
    assert not schema_diff(have, have)
