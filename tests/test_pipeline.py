"""Whole batches through files: re-runs, failures, order, rejects, quarantine."""

import os
from dataclasses import replace
from datetime import date, datetime
from decimal import Decimal

import pytest

from martloom import jobs
from martloom.plans import pipeline
from martloom.plans.mart import (
    BatchOutOfOrder,
    create_mart,
    expire_slices,
    fallback_columns,
    read_mart,
    seed_organizations,
)
from martloom.plans.pipeline import load_batch, run_batch, transform_batch
from martloom.plans.policy_mart import CONTRACTS, MART, ORG_CODES, STAGING
from martloom.plans.staging import LoadCounts, load_file
from martloom.sources.tables import batch_slice, read_table
from martloom.streaming.arrivals import load_arrivals
from tests.test_merge import table as rows_of

D1, D2, D3 = date(2026, 3, 31), date(2026, 4, 30), date(2026, 5, 31)
HEADS = {t: ",".join(c.names) for t, c in CONTRACTS.items()}


def at(day):
    return datetime(day.year, day.month, day.day, 6)


def basic(policy, ssn="111", first="Ann", last="Lee", status="ACTIVE", org="ail", dob="1970-01-01"):
    return f"{policy},{ssn},{first},{last},{dob},F,TERM_10,{status},2020-01-01,1000.00,{org}"


def address(policy, city="Town", org="ail"):
    return f"{policy},HOME,1 Street,,{city},TX,00001,2026-01-01,{org}"


def bank(policy, account="12345678", org="ail"):
    return f"{policy},Bank,110,{account},SAVINGS,2026-01-01,{org}"


def premium(number, policy, amount="10.00", org="ail"):
    return f"{policy},{number},2026-03-01,{amount},EFT,PAID,{org}"


def land(folder, org, **lines):
    """Files of one organisation; types not given are empty but for the header."""
    files = {}
    for file_type, head in HEADS.items():
        path = folder / f"{org}{file_type}.csv"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("\n".join([head, *lines.get(file_type, ())]) + "\n", encoding="utf-8")
        files[org, file_type] = str(path)
    return files


@pytest.fixture
def roots(tmp_path):
    return str(tmp_path / "staging"), str(tmp_path / "mart")


def first_batch(tmp_path):
    files = land(
        tmp_path / "1", "ail",
        basic=[basic("P1"), basic("P2", ssn="222", first="Bo"), basic("P3", ssn="", first="Cy"), basic("", ssn="9")],
        address=[address("P1"), address("P2", city=" ")],
        bankinfo=[bank("P1"), bank("P1", account="99999999")],
        premiums=[premium("T1", "P1"), premium("T1", "P1"), premium("T2", "P2"), premium("T2", "P2", "11.00")],
    )
    return files | land(
        tmp_path / "1", "lnl",
        basic=[basic("P1", ssn="111", org="lnl"), basic("P9", org="ail")],
        premiums=[premium("T3", "P1", org="lnl", amount="7.50")],
    )


def second_batch(tmp_path):
    return land(
        tmp_path / "2", "ail",
        basic=[basic("P1", status="LAPSED"), basic("P2", ssn="222", first="Beau"), basic("P4", ssn="444")],
        address=[address("P1", city="New"), address("P4")],
        bankinfo=[bank("P1", account="00001111")],
        premiums=[premium("T1", "P1"), premium("T4", "P4")],
    )


def snapshot(spark, mart):
    return {name: rows_of(read_mart(spark, name, mart)) for name in MART if name != "dim_organization"}


def test_two_batches(spark, tmp_path, roots):
    staging, mart = roots
    counts = run_batch(spark, first_batch(tmp_path), staging, mart, D1, at(D1))
    assert counts["ail", "basic"] == LoadCounts(total=4, valid=3, rejected=1)
    assert counts["lnl", "basic"] == LoadCounts(total=2, valid=1, rejected=1)
    assert counts["lnl", "address"] == LoadCounts(0, 0, 0)
    # Neither organisation's load has wiped the other's.
    staged = read_table(spark, STAGING["basic"], staging)
    assert rows_of(staged.groupBy("org_code").count()) == [("ail", 3), ("lnl", 1)]

    after_first = snapshot(spark, mart)
    assert [r[0] for r in after_first["fact_premiums"]] == ["T1", "T2", "T2", "T3"]
    assert after_first["fact_premiums"][-1][3] == Decimal("7.50")
    # Of two accounts of one policy the greatest is kept, whatever the order of the rows.
    assert [r[3] for r in after_first["dim_payment_method"]] == ["9999"]

    run_batch(spark, second_batch(tmp_path), staging, mart, D2, at(D2))
    policies = {(r.policy_number, r.org_code, r.is_current): r for r in read_mart(spark, "dim_policy", mart).collect()}
    assert set(policies) == {
        ("P1", "ail", False), ("P1", "ail", True), ("P2", "ail", True), ("P3", "ail", True),
        ("P4", "ail", True), ("P1", "lnl", True),
    }
    closed, opened = policies["P1", "ail", False], policies["P1", "ail", True]
    assert (closed.effective_date_scd, closed.end_date_scd, closed.updated_date) == (D1, date(2026, 4, 29), D2)
    assert (opened.policy_status, opened.effective_date_scd, opened.end_date_scd) == ("LAPSED", D2, None)

    people = {(r.policyholder_name, r.is_current) for r in read_mart(spark, "dim_policyholder", mart).collect()}
    assert people == {("ANN LEE", True), ("BO LEE", False), ("BEAU LEE", True), ("CY LEE", True)}
    by_name = [r for r in read_mart(spark, "dim_policyholder", mart).collect() if r.ssn_hash is None]
    assert [r.policyholder_business_key for r in by_name] == ["CY LEE_NAME_DOB"]

    cities = {r.policy_number: (r.city, r.created_date, r.updated_date) for r in read_mart(spark, "dim_address", mart).collect()}
    assert cities == {"P1": ("New", D1, D2), "P4": ("Town", D2, D2)}
    facts = [(r.transaction_id, r.premium_amount, r.batch_date) for r in read_mart(spark, "fact_premiums", mart).orderBy("transaction_id", "premium_amount").collect()]
    assert facts == [
        ("T1", Decimal("10.00"), D1), ("T2", Decimal("10.00"), D1), ("T2", Decimal("11.00"), D1),
        ("T3", Decimal("7.50"), D1), ("T4", Decimal("10.00"), D2),
    ]

    # Only the last batches' state is needed.
    before = snapshot(spark, mart)
    expire_slices(spark, mart, keep=2)
    assert snapshot(spark, mart) == before

    # The last batch again, with its files loaded again: the same state.
    run_batch(spark, second_batch(tmp_path), staging, mart, D2, at(D2))
    assert snapshot(spark, mart) == before
    with pytest.raises(ValueError):
        expire_slices(spark, mart, keep=1)
    with pytest.raises(BatchOutOfOrder):
        transform_batch(spark, staging, mart, D1, D1)


def test_a_corrected_file_replaces_the_batch(spark, tmp_path, roots):
    staging, mart = roots
    run_batch(spark, first_batch(tmp_path), staging, mart, D1, at(D1))
    run_batch(spark, second_batch(tmp_path), staging, mart, D2, at(D2))
    corrected = land(tmp_path / "c", "ail", basic=[basic("P2", ssn="222", first="Bo", status="PENDING")])
    run_batch(spark, corrected, staging, mart, D2, at(D2))
    rows = {(r.policy_number, r.org_code, r.policy_status, r.is_current) for r in read_mart(spark, "dim_policy", mart).collect()}
    assert rows == {
        ("P1", "ail", "ACTIVE", True), ("P2", "ail", "ACTIVE", False), ("P2", "ail", "PENDING", True),
        ("P3", "ail", "ACTIVE", True), ("P1", "lnl", "ACTIVE", True),
    }
    assert "T4" not in {r[0] for r in snapshot(spark, mart)["fact_premiums"]}


def test_a_batch_that_failed_half_way_is_run_again(spark, tmp_path, roots, monkeypatch):
    staging, mart = roots
    run_batch(spark, first_batch(tmp_path), staging, mart, D1, at(D1))
    whole = pipeline.transform_table

    def failing(spark, name, *rest):
        if name == "fact_premiums":
            raise RuntimeError("lost")
        whole(spark, name, *rest)

    monkeypatch.setattr(pipeline, "transform_table", failing)
    with pytest.raises(RuntimeError, match="lost"):
        run_batch(spark, second_batch(tmp_path), staging, mart, D2, at(D2))
    monkeypatch.setattr(pipeline, "transform_table", whole)
    transform_batch(spark, staging, mart, D2, D2)
    assert "T4" in {r[0] for r in snapshot(spark, mart)["fact_premiums"]}
    assert len(snapshot(spark, mart)["dim_policy"]) == 6
    # A batch without files of some organisation, or any rows, keeps what there is.
    run_batch(spark, land(tmp_path / "3", "ail"), staging, mart, D3, at(D3))
    assert len(snapshot(spark, mart)["dim_policy"]) == 6
    # With the oldest state gone, the last batch can still be run again.
    before = snapshot(spark, mart)
    expire_slices(spark, mart)
    transform_batch(spark, staging, mart, D3, D3)
    assert snapshot(spark, mart) == before


def test_rejects_and_quarantine(spark, tmp_path, roots):
    staging, _ = roots
    contract = CONTRACTS["basic"].for_org("ail")
    files = first_batch(tmp_path)
    load_file(spark, files["ail", "basic"], contract, staging, D1, at(D1), reject_format="csv")
    folder = f"{staging}/rejected/file_org=ail/batch_date={D1}/file_type=basic"
    [reject] = spark.read.option("header", True).csv(folder).collect()
    assert reject.rejection_reason == "null_or_empty: policy_number"
    assert "ssn" not in reject.asDict() and len(reject.ssn_hash) == 64
    # A row of another organisation keeps its own code among the rejects.
    load_file(spark, files["lnl", "basic"], CONTRACTS["basic"].for_org("lnl"), staging, D1, at(D1))
    [stray] = spark.read.parquet(folder.replace("=ail", "=lnl")).collect()
    assert stray.org_code == "ail" and stray.rejection_reason == "org_code mismatch: expected lnl"
    # Loaded again from a clean file, the old rejects are gone.
    clean = land(tmp_path / "clean", "ail", basic=[basic("P1")])
    load_file(spark, clean["ail", "basic"], contract, staging, D1, at(D1), reject_format="csv")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.csv(folder)

    # A contract that lacks a column the table needs: nothing is loaded, all is kept as JSON.
    thin = replace(
        contract, columns=tuple(c for c in contract.columns if c.name != "policy_status"),
        not_null=tuple(n for n in contract.not_null if n != "policy_status"),
    )
    counts = load_file(spark, clean["ail", "basic"], thin, staging, D1, at(D1))
    assert counts == LoadCounts(total=1, valid=0, rejected=0, quarantined=1)
    # What a good load had staged stays.
    assert read_table(spark, STAGING["basic"], staging).where("org_code = 'ail'").count() == 1
    [kept] = read_table(spark, STAGING["rejected"], staging).collect()
    assert kept.file_type == "basic" and "missing: policy_status" in kept.rejection_reason
    # Landed columns, whole but for what is masked.
    assert '"policy_number":"P1"' in kept.raw_record and '"111"' not in kept.raw_record
    assert '"gender":"F"' in kept.raw_record and '"face_amount":"1000.00"' in kept.raw_record


def test_amounts_too_big_for_the_table(spark, tmp_path, roots):
    staging, _ = roots
    contract = CONTRACTS["premiums"].for_org("ail")
    lines = [premium("T1", "P1"), premium("T2", "P1", amount="12345678901.00")]
    files = land(tmp_path / "big", "ail", premiums=lines)
    with pytest.raises(Exception, match="does not fit premium_amount"):
        load_file(spark, files["ail", "premiums"], contract, staging, D1, at(D1), strict=False)
    counts = load_file(spark, files["ail", "premiums"], contract, staging, D1, at(D1))
    assert counts == LoadCounts(total=2, valid=1, rejected=1)


def test_commands(spark, tmp_path, roots):
    staging, mart = roots
    files = first_batch(tmp_path)

    def run(*argv):
        return jobs.run(spark, jobs.arguments(argv), at(D1))

    assert run("create", "--mart", mart) == 0
    for (org, file_type), path in files.items():
        rejected = run(
            "load", "--org", org, "--file-type", file_type, "--batch-date", str(D1), "--input", path, "--staging", staging
        )
        assert rejected == {("ail", "basic"): 1, ("lnl", "basic"): 1, ("ail", "address"): 1}.get((org, file_type), 0)
    run("transform", "--batch-date", str(D1), "--staging", staging, "--mart", mart)
    # The two amounts of T2 are the one fault.
    assert run("check", "--mart", mart) == 1
    assert read_mart(spark, "dim_organization", mart).count() == 4
    run("truncate", "--staging", staging, "--mart", mart)
    assert read_mart(spark, "dim_policy", mart).count() == 0
    assert read_table(spark, STAGING["basic"], staging).count() == 0
    assert {r.org_code for r in read_mart(spark, "dim_organization", mart).collect()} == set(ORG_CODES)


def test_seeding_twice(spark, roots):
    _, mart = roots
    create_mart(spark, mart)
    for _ in range(2):
        seed_organizations(spark, mart, D1)
    assert read_mart(spark, "dim_organization", mart).count() == 4


def test_arrivals_are_loaded_once(spark, tmp_path, roots):
    staging, mart = roots
    contract = CONTRACTS["basic"].for_org("ail")
    folder = tmp_path / "arriving"

    def arrive(name, *lines):
        folder.mkdir(exist_ok=True)
        (folder / name).write_text("\n".join([HEADS["basic"], *lines]) + "\n", encoding="utf-8")
        streams = load_arrivals(
            spark, str(folder), contract, staging, D1, at(D1), str(tmp_path / "progress")
        )
        assert all(stream.awaitTermination(60) for stream in streams)
        staged = batch_slice(read_table(spark, STAGING["basic"], staging), D1)
        rejects = spark.read.parquet(f"{staging}/rejected")
        return sorted(r.policy_number for r in staged.collect()), rejects.count()

    assert arrive("a.csv", basic("P1"), basic("", ssn="2")) == (["P1"], 1)
    assert arrive("b.csv", basic("P2")) == (["P1", "P2"], 1)
    assert arrive("c.csv") == (["P1", "P2"], 1)
    # What a stream has staged is transformed like any batch.
    transform_batch(spark, staging, mart, D1, D1)
    assert {r[0] for r in snapshot(spark, mart)["dim_policy"]} == {"P1", "P2"}


def test_loads_run_side_by_side(spark, tmp_path, roots):
    staging, _ = roots
    missing = {("ail", "basic"): str(tmp_path / "none.csv")}
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        load_batch(spark, missing, staging, D1, at(D1))


def test_a_late_and_old_file_is_staged(spark, tmp_path, roots):
    staging, _ = roots
    contract = CONTRACTS["basic"].for_org("ail")
    folder = tmp_path / "arriving"
    folder.mkdir()

    def arrive(**files):
        for name, (line, age_days) in files.items():
            path = folder / f"{name}.csv"
            path.write_text(f"{HEADS['basic']}\n{line}\n", encoding="utf-8")
            then = path.stat().st_mtime - age_days * 86_400
            os.utime(path, (then, then))
        streams = load_arrivals(
            spark, str(folder), contract, staging, D1, at(D1), str(tmp_path / "progress"), salt="s"
        )
        assert all(stream.awaitTermination(60) for stream in streams)
        return sorted(r.policy_number for r in read_table(spark, STAGING["basic"], staging).collect())

    assert arrive(a=(basic("A1"), 0)) == ["A1"]
    assert arrive(b=(basic("B1"), 10), c=(basic("C1"), 0)) == ["A1", "B1", "C1"]
    # Rows of another length are rejects in a stream too.
    assert arrive(d=(basic("D1") + ",one,two", 0)) == ["A1", "B1", "C1"]
    reasons = {r.rejection_reason for r in spark.read.parquet(f"{staging}/rejected").collect()}
    assert reasons == {"malformed_row"}


def test_marked_columns_are_hidden_in_rejects_too(spark, tmp_path, roots):
    staging, _ = roots
    plain = CONTRACTS["basic"].for_org("ail")
    marked = replace(
        plain,
        columns=tuple(replace(c, pii=c.pii or c.name in ("first_name", "last_name", "dob")) for c in plain.columns),
    )
    files = land(tmp_path / "pii", "ail", basic=[basic("P1"), basic("", first="Zoe")])
    load_file(spark, files["ail", "basic"], marked, staging, D1, at(D1))
    for path in (f"{staging}/rejected", f"{staging}/stg_basic"):
        text = str([r.asDict() for r in spark.read.parquet(path).collect()])
        assert "ZOE" not in text and "ANN" not in text and "LEE" not in text and "1970" not in text


def test_people_of_one_name_are_told_apart_by_the_contract(spark, tmp_path, roots):
    staging, mart = roots
    files = land(
        tmp_path / "1", "ail",
        basic=[basic("P1", ssn="", dob="1970-01-01"), basic("P2", ssn="", dob="1980-01-01")],
    )
    fallback = fallback_columns(CONTRACTS["basic"])
    run_batch(spark, files, staging, mart, D1, at(D1), fallback=fallback)
    keys = {r.policyholder_business_key for r in read_mart(spark, "dim_policyholder", mart).collect()}
    assert keys == {"ANN LEE_1970-01-01_NAME_DOB", "ANN LEE_1980-01-01_NAME_DOB"}


def test_exit_status():
    def status(found, *argv):
        return jobs.exit_status(jobs.arguments(argv), found)

    load = "load --org a --file-type basic --batch-date 2026-03-31 --input i --staging s".split()
    assert status(0, "check", "--mart", "m") == 0
    assert status(3, "check", "--mart", "m") == 1
    assert status(3, *load) == 0
    assert status(3, *load, "--max-rejects", "3") == 0
    assert status(4, *load, "--max-rejects", "3") == 1
