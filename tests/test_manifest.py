"""What makes up a mart: one publication per batch, and only the buckets a batch touches."""

from pathlib import Path

import pytest

from martloom.plans import manifest, pipeline
from martloom.plans.manifest import PublishedMeanwhile, TableState, latest, publish, snapshots
from martloom.plans.mart import (
    SOURCES,
    base_of,
    create_mart,
    expire_slices,
    read_mart,
    read_mart_tables,
    truncate_mart,
)
from martloom.plans.pipeline import run_batch, transform_batch
from martloom.sources.tables import write_new
from tests.test_pipeline import (
    D1,
    D2,
    D3,
    address,
    at,
    bank,
    basic,
    first_batch,
    land,
    premium,
    roots,  # noqa: F401
    second_batch,
    snapshot,
)


@pytest.mark.parametrize("lost", ["dim_policyholder", "fact_premiums"])
def test_a_failure_between_tables_leaves_all_on_the_old_batch(spark, tmp_path, roots, monkeypatch, lost):  # noqa: F811
    staging, mart = roots
    run_batch(spark, first_batch(tmp_path), staging, mart, D1, at(D1))
    before = snapshot(spark, mart)
    whole = pipeline.transform_table

    def failing(spark, name, *rest):
        state = whole(spark, name, *rest)
        if name == lost:
            raise RuntimeError("lost")
        return state

    monkeypatch.setattr(pipeline, "transform_table", failing)
    with pytest.raises(RuntimeError, match="lost"):
        run_batch(spark, second_batch(tmp_path), staging, mart, D2, at(D2))
    assert snapshot(spark, mart) == before
    monkeypatch.setattr(pipeline, "transform_table", whole)
    transform_batch(spark, staging, mart, D2, D2)
    after = snapshot(spark, mart)
    assert all(after[name] != before[name] for name in SOURCES)
    # What the failed run left behind goes with the replaced state.
    expire_slices(spark, mart)
    assert snapshot(spark, mart) == after


def test_readers_keep_the_batch_they_began_with(spark, tmp_path, roots):  # noqa: F811
    staging, mart = roots
    run_batch(spark, first_batch(tmp_path), staging, mart, D1, at(D1))
    tables, expected = read_mart_tables(spark, mart), snapshot(spark, mart)
    run_batch(spark, second_batch(tmp_path), staging, mart, D2, at(D2))
    run_batch(spark, second_batch(tmp_path), staging, mart, D2, at(D2))
    for name, rows in expected.items():
        assert sorted(map(tuple, tables[name].collect()), key=str) == sorted(rows, key=str)


def bytes_of(mart, name, folders):
    return sum(f.stat().st_size for folder in folders for f in Path(mart, name, folder).rglob("*.parquet"))


def test_a_small_batch_rewrites_its_buckets_only(spark, tmp_path, roots):  # noqa: F811
    staging, mart = roots
    ids = [f"P{i:05d}" for i in range(2_000)]
    files = land(
        tmp_path / "1", "ail",
        basic=[basic(p, ssn=f"{i:09d}", first="Ann") for i, p in enumerate(ids)],
        address=[address(p) for p in ids],
        bankinfo=[bank(p) for p in ids],
        premiums=[premium(f"T{p}", p) for p in ids],
    )
    create_mart(spark, mart, buckets=64)
    run_batch(spark, files, staging, mart, D1, at(D1))
    first = latest(spark, mart)
    assert all(len(first.of(name).current) == 64 for name in SOURCES if name != "fact_premiums")
    few = ids[:3]
    files = land(
        tmp_path / "2", "ail",
        basic=[basic(p, ssn=f"{i:09d}", first="Ann", status="LAPSED") for i, p in enumerate(few)],
        address=[address(p, city="New") for p in few],
        bankinfo=[bank(p, account="00001111") for p in few],
    )
    run_batch(spark, files, staging, mart, D2, at(D2))
    second = latest(spark, mart)
    for name in SOURCES:
        old, new = first.of(name), second.of(name)
        written = [f for f in new.folders() if f not in old.folders()]
        if name == "fact_premiums":
            continue
        replaced = [b for b, f in new.current.items() if old.current.get(b) != f]
        assert 1 <= len(replaced) <= 3
        assert bytes_of(mart, name, written) < 0.2 * bytes_of(mart, name, old.folders())
    rows = read_mart(spark, "dim_policy", mart)
    assert rows.where("is_current").count() == 2_000 and rows.count() == 2_003
    assert rows.where("is_current AND policy_status = 'LAPSED'").count() == 3
    assert read_mart(spark, "dim_address", mart).where("city = 'New'").count() == 3
    # Only the touched buckets' folders are listed.
    base = base_of(spark, mart, D2)
    assert base.number == first.number
    before = snapshot(spark, mart)
    expire_slices(spark, mart)
    transform_batch(spark, staging, mart, D2, D2)
    assert snapshot(spark, mart) == before
    run_batch(spark, land(tmp_path / "3", "ail"), staging, mart, D3, at(D3))
    assert latest(spark, mart).of("dim_policy").current == second_of(spark, mart).of("dim_policy").current


def second_of(spark, mart):
    return snapshots(spark, mart)[-2]


def test_of_two_publishers_one_fails(spark, tmp_path):
    root = str(tmp_path / "mart")
    publish(spark, root, None, 4, {}, None)
    seen = latest(spark, root)
    state = {"dim_policy": TableState({3: "a/bucket=3", 0: "b/bucket=0"}, ("c",))}
    published = publish(spark, root, D1, 4, state, seen)
    assert latest(spark, root) == published and published.of("dim_policy").folders() == ("a/bucket=3", "b/bucket=0", "c")
    with pytest.raises(PublishedMeanwhile):
        publish(spark, root, D1, 4, {}, seen)
    # An entry that was cut off neither counts nor stands in the way.
    write_new(spark, f"{root}/_batches/00000003.json", '{"batch": "2026-')
    assert latest(spark, root) == published
    assert publish(spark, root, D2, 4, state, published).number == 4
    manifest.forget(spark, root, [published])
    assert snapshots(spark, root) == [published]


def test_an_emptied_mart_starts_anew(spark, tmp_path, roots):  # noqa: F811
    staging, mart = roots
    run_batch(spark, first_batch(tmp_path), staging, mart, D1, at(D1))
    whole = snapshot(spark, mart)
    truncate_mart(spark, mart)
    assert not any(snapshot(spark, mart).values())
    transform_batch(spark, staging, mart, D1, D1)
    assert snapshot(spark, mart) == whole
