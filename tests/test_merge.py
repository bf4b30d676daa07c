"""Merges against a model in plain Python, over both plans."""

import uuid
from datetime import date, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martloom.operators import sizing
from martloom.operators.dedup import (
    DuplicateKeys,
    duplicate_keys,
    first_per_key,
    latest_per_key,
    measured_unique,
    require_unique,
)
from martloom.operators.merge import Scd1, Scd2, scd1_upsert, scd2_merge
from martloom.operators.quality import interval_faults, multiple_current
from martloom.operators.schema import columns
from martloom.sources.tables import empty_rows

DIM = columns(
    k="INT", org="STRING", v="STRING", note="STRING", is_current="BOOLEAN", effective_date="DATE",
    end_date="DATE", created_date="DATE", updated_date="DATE",
)
SPEC = Scd2(keys=("k", "org"), tracked=("v",))
SOURCE = "k int, org string, v string, note string"
DAYS = [date(2026, 1, 31), date(2026, 2, 28), date(2026, 3, 31)]
MANY = settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def table(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def model_scd2(dim, source, day, *, expire_only=False, null_safe=True):
    """One pass of the merge over lists of rows."""
    current = {(r[0], r[1]): r for r in dim if r[4] and None not in r[:2]}
    out = list(dim)
    for k, org, v, note in source:
        old = current.get((k, org)) if None not in (k, org) else None
        fresh = (k, org, v, note, True, day, None, day, day)
        if old is None:
            out.append(fresh)
            continue
        differs = old[2] != v if null_safe else None not in (old[2], v) and old[2] != v
        if differs:
            out.remove(old)
            out.append((*old[:4], False, old[5], day - timedelta(days=1), old[7], day))
            if not expire_only:
                out.append(fresh)
    return sorted(out, key=str)


batches = st.lists(
    st.dictionaries(
        st.tuples(st.sampled_from([1, 2, 3, 4, None]), st.sampled_from(["a", "b", None])),
        st.tuples(st.sampled_from(["x", "y", None]), st.sampled_from(["n", None])),
        max_size=8,
    ),
    min_size=3, max_size=3,
)


@pytest.mark.parametrize("broadcast", [True, False])
@pytest.mark.parametrize("options", [{}, {"expire_only": True, "null_safe": False}])
@MANY
@given(batches)
def test_scd2_follows_model(spark, broadcast, options, batches):
    dim, model = [], []
    for day, batch in zip(DAYS, batches):
        source = [(*key, *value) for key, value in batch.items()]
        merged = scd2_merge(
            spark.createDataFrame(dim, DIM), spark.createDataFrame(source, SOURCE), SPEC, day, day,
            broadcast_source=broadcast, **options,
        )
        dim = table(merged)
        model = model_scd2(model, source, day, **options)
        assert dim == model


@MANY
@given(batches)
def test_scd2_properties(spark, batches):
    """A batch merged again changes nothing; expiring twice is merging once; history is sound."""
    dim = empty_rows(spark, DIM)
    for day, batch in zip(DAYS, batches):
        rows = [(*key, *value) for key, value in batch.items() if None not in key]
        source = spark.createDataFrame(rows, SOURCE)
        once = spark.createDataFrame(table(scd2_merge(dim, source, SPEC, day, day, broadcast_source=False)), DIM)
        again = scd2_merge(once, source, SPEC, day, day, broadcast_source=True)
        assert table(again) == table(once)
        literal = scd2_merge(dim, source, SPEC, day, day, expire_only=True, broadcast_source=False)
        literal = scd2_merge(
            spark.createDataFrame(table(literal), DIM), source, SPEC, day, day, expire_only=True,
            broadcast_source=False,
        )
        assert table(literal) == table(once)
        dim = once
    assert multiple_current(dim, SPEC).isEmpty()
    assert interval_faults(dim, SPEC).isEmpty()


CONTACTS = columns(
    k="INT", v="STRING", note="STRING", is_current="BOOLEAN", created_date="DATE", updated_date="DATE"
)
CONTACT = Scd1(keys=("k",), attributes=("v", "note"))


@pytest.mark.parametrize("broadcast", [True, False])
def test_scd1_upsert(spark, broadcast):
    first, second = DAYS[:2]
    target = spark.createDataFrame(
        [(1, "a", "n", True, first, first), (2, "b", None, True, first, first)], CONTACTS
    )
    source = spark.createDataFrame([(2, None, "m"), (3, "c", None)], "k int, v string, note string")
    merged = scd1_upsert(target, source, CONTACT, second, broadcast_source=broadcast)
    assert table(merged) == [
        (1, "a", "n", True, first, first),
        (2, None, "m", True, first, second),
        (3, "c", None, True, second, second),
    ]
    again = scd1_upsert(merged, source, CONTACT, second, broadcast_source=broadcast)
    assert table(again) == table(merged)


def test_scd1_duplicate_sources(spark):
    source = spark.createDataFrame([(1, "a", "n"), (1, "b", "m"), (2, "c", "x")], "k int, v string, note string")
    empty = empty_rows(spark, CONTACTS)
    with pytest.raises(DuplicateKeys, match=r"\(1,\)"):
        scd1_upsert(empty, source, CONTACT, DAYS[0])
    merged = scd1_upsert(empty, source, CONTACT, DAYS[0], order=())
    assert [r[:3] for r in table(merged)] == [(1, "b", "m"), (2, "c", "x")]


def test_first_per_key_is_deterministic(spark):
    rows = [(1, 5, "a"), (1, 5, "b"), (1, None, "c"), (2, None, "d"), (None, 1, "e"), (None, 2, "f")]
    for parts in (1, 5):
        df = spark.createDataFrame(rows, "k int, t int, v string").repartition(parts)
        assert table(latest_per_key(df, ["k"], ["t"])) == [(1, 5, "b"), (2, None, "d"), (None, 2, "f")]


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(20000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    plan = latest_per_key(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    kept = first_per_key(df, ["k"], [F.col("id").desc()])
    assert kept.where("k = 0").collect()[0]["id"] == 19998 and kept.count() == df.select("k").distinct().count()


def test_duplicate_gate(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    assert table(duplicate_keys(df, ["k"])) == [(1, 2)]
    assert require_unique(df, ["k", "v"]) is df
    with pytest.raises(DuplicateKeys):
        require_unique(df, ["k"])


def test_gate_and_measure_in_one_job(spark, monkeypatch):
    df = spark.createDataFrame([(1, "a", 2), (1, "b", 2), (None, "c", 3)], "k int, `v.w` string, _rows int")
    assert measured_unique(df, ["k", "v.w"])
    assert measured_unique(df.limit(0), ["k"])
    with pytest.raises(DuplicateKeys, match=r"\(1, 2\)"):
        measured_unique(df, ["k", "_rows"])
    with pytest.raises(DuplicateKeys, match=r"\(None,\)"):
        measured_unique(df.where("k IS NULL").unionAll(df.where("k IS NULL")), ["k"])

    def jobs(run):
        group = f"gate-{uuid.uuid4().hex}"
        spark.sparkContext.setJobGroup(group, "counted")
        run()
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    unique = df.where("k = 1").select("`v.w`", "_rows").withColumnRenamed("v.w", "v")
    apart = jobs(lambda: (require_unique(unique, ["v"]), sizing.fits_broadcast(unique)))
    assert jobs(lambda: measured_unique(unique, ["v"])) < apart

    monkeypatch.setattr(sizing, "BROADCAST_ROWS", 1)
    assert not measured_unique(unique, ["v"]) and not sizing.fits_broadcast(unique)
    monkeypatch.setattr(sizing, "NOT_WORTH_MEASURING", -1)
    monkeypatch.setattr(sizing, "BROADCAST_ROWS", 10)
    assert not measured_unique(spark.range(3), ["id"])
    with pytest.raises(DuplicateKeys, match=r"\(0,\)"):
        measured_unique(spark.range(4).selectExpr("id DIV 3 AS k"), ["k"])
