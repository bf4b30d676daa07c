from datetime import date, timedelta
from random import Random

import pytest
from pyspark.sql import functions as F

from martloom.operators import quality, sizing, skew
from martloom.operators.append import new_facts
from martloom.operators.merge import Scd2
from martloom.operators.schema import columns
from tests.test_merge import DIM, SPEC, table


@pytest.mark.parametrize("broadcast", [True, False, None])
def test_new_facts(spark, broadcast):
    held = spark.createDataFrame([("1", 10), ("1", 11), ("2", 20)], "id string, amount int")
    batch = spark.createDataFrame(
        [("2", 99), ("3", 30), ("3", 30), ("4", 40), ("4", 41), (None, 5), (None, 5)], "id string, amount int"
    )
    added = new_facts(batch, held, ["id"], broadcast_keys=broadcast)
    # One id with two amounts stays two rows; equal rows become one; NULL meets nothing.
    assert table(added) == [("3", 30), ("4", 40), ("4", 41), (None, 5)]
    one = new_facts(batch, held, ["id"], one_per_key=True, broadcast_keys=broadcast)
    assert table(one) == [("3", 30), ("4", 41), (None, 5)]
    assert new_facts(batch.where("id is not null"), held.union(added), ["id"]).isEmpty()


@pytest.mark.parametrize("hot_rows", [1, 4, 1000])
def test_hot_keys_leave_results_alone(spark, hot_rows):
    left = spark.range(60).selectExpr(
        "CAST(CASE WHEN id % 3 = 0 THEN 7 WHEN id = 1 THEN NULL ELSE id % 5 END AS INT) AS k", "id"
    )
    right = spark.createDataFrame([(k, k == 7, f"v{k}") for k in (0, 1, 7)] + [(None, True, "n")], "k int, f boolean, v string")
    joined = skew.lookup_join(left, right, ["k"], broadcast_right=False, hot_rows=hot_rows)
    assert table(joined) == table(left.join(right, ["k"]))


def test_hottest_keys(spark):
    df = spark.range(30).selectExpr("CASE WHEN id < 20 THEN 1 ELSE id END AS k")
    assert table(skew.hottest_keys(df, ["k"], 10)) == [(1,)]
    assert skew.hottest_keys(df, ["k"], 21) is None


def test_target_is_read_on_its_keys_only(spark, tmp_path):
    wide = spark.range(100).selectExpr("id", "id * 2 AS a", "id * 3 AS b")
    wide.write.parquet(str(tmp_path / "t"))
    held = spark.read.parquet(str(tmp_path / "t"))
    plan = new_facts(wide, held, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint>" in plan


def test_measure(spark):
    df = spark.createDataFrame([("abc", 1), (None, 2)], "s string, i int")
    size = sizing.measure(df)
    assert size.rows == 2 and size.bytes == 2 * 3 * sizing.SLOT_BYTES + 3
    assert sizing.fits_broadcast(df)
    assert not sizing.fits_broadcast(spark.range(sizing.BROADCAST_ROWS + 1))
    assert sizing.measure(df.limit(0)) == sizing.Size(0, 0)


def test_orphans_and_domains(spark):
    fact = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (3, "c"), (None, None)], "k int, org string")
    dim = spark.createDataFrame([(1, "a", True), (1, "a", False), (2, "x", True)], "k int, org string, is_current boolean")
    assert table(quality.orphans(fact, dim, ["k", "org"])) == [(2, "b", 1), (3, "c", 1), (None, None, 1)]
    assert table(quality.outside_domain(fact, "org", dim, "org")) == [("b", 1), ("c", 1), (None, 1)]
    assert table(quality.outside_list(fact, "org", ["a", "b"])) == [("c", 1), (None, 1)]
    joined = quality.fact_dim_join(fact, dim.withColumn("v", F.lit(1)), ["k", "org"], ["v"])
    assert table(joined) == [(1, "a", 1), (1, "a", 1)]


def test_counts(spark):
    df = spark.createDataFrame([(1, "a"), (None, "a"), (2, None)], "k int, v string")
    assert table(quality.null_counts(df, ["k", "v"])) == [("k", 1), ("v", 1)]
    assert quality.distinct_key_count(df, ["k", "v"]).first().n_keys == 1
    assert tuple(quality.count_and_max(df, "k").first()) == (3, 2)
    assert table(quality.row_counts({"x": df, "y": df.limit(0)})) == [("x", 3), ("y", 0)]


def test_column_report(spark):
    df = spark.createDataFrame([(1, "a", 2.0), (None, "b", None)], "k int, v string, old double")
    target = columns(k="INT NOT NULL", v="DATE", w="STRING")
    report = {r.column_name: (r.status, r.n_nulls) for r in quality.column_report(df, target, ["old"]).collect()}
    assert report == {
        "k": ("has_nulls", 1), "v": ("retyped", 0), "w": ("missing", None), "old": ("forbidden", 1),
    }


def versions(*spans):
    day = date(2026, 1, 1)
    return [
        (k, "a", "v", None, end is None, day + timedelta(start),
         None if end is None else day + timedelta(end), day, day)
        for k, start, end in spans
    ]


def test_interval_faults(spark):
    sound = versions((1, 0, 9), (1, 10, 10), (1, 11, None), (2, 5, None), (3, 0, 3), (3, 4, None))
    assert interval_faults_of(spark, sound) == set()
    assert interval_faults_of(spark, versions((1, 0, 9), (1, 12, None))) == {(1, 10, "no_successor")}
    assert interval_faults_of(spark, versions((1, 0, 9), (1, 5, None))) == {(1, 10, "no_successor")}
    assert interval_faults_of(spark, versions((1, 0, None), (1, 5, None))) == {(1, None, "several_open")}
    assert interval_faults_of(spark, versions((1, 3, 1), (1, 2, None))) == {(1, 3, "ends_before_start")}


def interval_faults_of(spark, rows):
    faults = quality.interval_faults(spark.createDataFrame(rows, DIM), SPEC).collect()
    return {(r.k, None if r.at_date is None else (r.at_date - date(2026, 1, 1)).days, r.fault) for r in faults}


def is_chain(spans):
    """Whether the versions of one key, in order, follow each other without gap or overlap."""
    spans = sorted(spans, key=lambda s: s[0])
    ends = [e for _, e in spans]
    if any(e is not None and e < s for s, e in spans) or None in ends[:-1]:
        return False
    follows = all(a[1] + 1 == b[0] for a, b in zip(spans, spans[1:]))
    return follows and (ends[-1] is None)


def test_interval_faults_find_exactly_the_broken_histories(spark):
    random = Random(7)
    spans = {}
    for key in range(300):
        cuts = sorted(random.sample(range(1, 40), random.randint(0, 4)))
        starts, ends = [0, *cuts], [c - 1 for c in cuts] + [None]
        history = list(zip(starts, ends))
        for _ in range(random.choice([0, 0, 1, 2])):
            i = random.randrange(len(history))
            s, e = history[i]
            history[i] = random.choice([(s + 1, e), (s, (e if e is not None else 40) + 1), (s, None), (s, e)])
        spans[key] = history
    rows = versions(*[(k, s, e) for k, h in spans.items() for s, e in h])
    broken = {k for k, _, _ in interval_faults_of(spark, rows)}
    # A history that was closed and never reopened has a last end without a successor.
    assert broken == {k for k, h in spans.items() if not is_chain(h)}


def test_multiple_current(spark):
    rows = versions((1, 0, None), (1, 2, None), (2, 0, 3), (2, 4, None))
    spec = Scd2(keys=("k",), tracked=("v",))
    assert table(quality.multiple_current(spark.createDataFrame(rows, DIM), spec)) == [(1, 2)]


def test_hot_keys_of_a_chain_of_joins_are_counted_before_the_joins(spark, monkeypatch):
    facts = spark.createDataFrame([(1, 1), (1, 2), (1, 3), (2, 4), (None, 5), (3, 6)], "k int, v int")
    first = spark.createDataFrame([(1, "x"), (2, "y"), (4, "z")], "k int, a string")
    second = spark.createDataFrame([(1, "p"), (2, "q"), (3, "r")], "k int, b string")
    counted = []
    find = skew.hottest_keys
    monkeypatch.setattr(skew, "hottest_keys", lambda df, *more: counted.append(df) or find(df, *more))
    for hot_rows in (1, 2, 100):
        joined = skew.lookup_join(facts, first, ["k"], broadcast_right=False, hot_rows=hot_rows)
        joined = skew.lookup_join(
            joined, second, ["k"], broadcast_right=False, hot_rows=hot_rows, counted_in=facts
        )
        rows = sorted(tuple(r) for r in joined.select("k", "v", "a", "b").collect())
        assert rows == [(1, 1, "x", "p"), (1, 2, "x", "p"), (1, 3, "x", "p"), (2, 4, "y", "q")]
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in counted]
    assert len(plans) == 6 and not any("Join" in plan for plan in plans)
