"""Key sketches: no key is missed, and parts without common keys are not opened."""

import random

import pytest
from pyspark.sql import functions as F

from martloom.operators.append import new_facts
from martloom.operators.sketch import key_sketch, parts_that_may_hold, sketches_of
from martloom.sources import sketched
from martloom.sources.sketched import append_part, parts, parts_to_open


def longs(spark, values):
    return spark.createDataFrame([(v,) for v in values], "k long")


@pytest.mark.parametrize("dense", [True, False])
def test_no_common_key_is_missed(spark, dense):
    random.seed(1)
    edges = [0, -1, 1, 32_767, 32_768, 32_769, -32_768, 2**62, -(2**62), 65_536]
    batch = longs(spark, [*edges, None])
    held = {str(v): key_sketch(longs(spark, [v, v + 5_000_000]), ["k"], dense=dense) for v in edges}
    assert parts_that_may_hold(sketches_of(held), key_sketch(batch, ["k"], dense=dense)) == sorted(held)


def test_dense_sketches_are_exact(spark):
    held = {"even": longs(spark, range(0, 200_000, 2)), "nulls": longs(spark, [None]), "none": longs(spark, [])}
    sketches = sketches_of({n: key_sketch(d, ["k"], dense=True) for n, d in held.items()})
    assert sketches.where("part <> 'even'").count() == 0
    odd = key_sketch(longs(spark, range(1, 200_000, 2)), ["k"], dense=True)
    assert parts_that_may_hold(sketches, odd) == []
    one = key_sketch(longs(spark, [7, 131_072]), ["k"], dense=True)
    assert parts_that_may_hold(sketches, one) == ["even"]
    with pytest.raises(ValueError, match="one integer"):
        key_sketch(longs(spark, []).withColumn("s", F.lit("a")), ["k", "s"], dense=True)


def test_hashed_sketches_tell_parts_apart(spark):
    def words(name, n):
        return spark.range(n).select(F.concat(F.lit(name), "id").alias("k"), F.col("id").alias("n"))

    held = sketches_of({name: key_sketch(words(name, 500), ["k", "n"]) for name in "abc"})
    assert parts_that_may_hold(held, key_sketch(words("b", 20), ["k", "n"])) == ["b"]


FACTS = "k long, v string"


def test_only_parts_with_common_keys_are_read(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "facts")
    for i in range(5):
        rows = [(k, f"part {i}") for k in range(1_000 * i, 1_000 * (i + 1))]
        append_part(spark.createDataFrame(rows, FACTS), path, f"b{i}", ["k"], dense=True)
    read = []
    plain = sketched.read_parts
    monkeypatch.setattr(sketched, "read_parts", lambda s, p, f, like: read.append([x.rpartition("=")[2] for x in f]) or plain(s, p, f, like))
    batch = spark.createDataFrame([(k, "late") for k in [*range(3_990, 4_000), *range(9_000, 9_010), None]], FACTS)
    added = append_part(batch, path, "b5", ["k"], dense=True)
    assert read == [["b3"], ["b5"]]
    assert sorted(map(tuple, added.collect()), key=str) == sorted([(k, "late") for k in [*range(9_000, 9_010), None]], key=str)
    assert all("part=b5" in f for f in added.inputFiles())
    # The same batch again: its own part is no obstacle, and is replaced.
    assert append_part(batch, path, "b5", ["k"], dense=True).count() == 11
    assert sum(spark.read.parquet(f).count() for f in parts(spark, path).values()) == 5_011


def test_a_part_without_sketch_is_opened(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "facts")
    append_part(spark.createDataFrame([(1, "a")], FACTS), path, "a / b", ["k"])
    monkeypatch.setattr(sketched, "key_sketch", lambda *a, **b: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        append_part(spark.createDataFrame([(2, "b")], FACTS), path, "c", ["k"], broadcast_keys=True)
    monkeypatch.undo()
    assert sorted(parts(spark, path)) == ["a / b"]  # the sketch of the batch was lost before the part was written
    spark.createDataFrame([(2, "b")], FACTS).write.parquet(f"{path}/part=c")
    batch = spark.createDataFrame([(2, "again"), (3, "new")], FACTS)
    assert list(parts_to_open(batch, path, ["k"], dense=False, part="d")) == ["c"]
    assert [tuple(r) for r in append_part(batch, path, "d", ["k"]).collect()] == [(3, "new")]


def test_held_keys_out_of_range_are_skipped_by_the_scan(spark, tmp_path):
    path = str(tmp_path / "held")
    spark.range(1_000).selectExpr("id AS k", "'x' AS v").write.parquet(path)
    held = spark.read.parquet(path)
    batch = spark.createDataFrame([(990, "y"), (1_010, "z"), (1_010, "z")], FACTS)
    for broadcast_keys in (True, False):
        added = new_facts(batch, held, ["k"], broadcast_keys=broadcast_keys)
        plan = added._jdf.queryExecution().executedPlan().toString()
        assert "GreaterThanOrEqual(k,990)" in plan and "LessThanOrEqual(k,1010)" in plan
        # Rows held go before duplicates are looked for.
        assert plan.index("LeftAnti") > plan.index("HashAggregate")
        assert [tuple(r) for r in added.collect()] == [(1_010, "z")]
    nothing = new_facts(spark.createDataFrame([(None, "n")], FACTS), held, ["k"])
    assert [tuple(r) for r in nothing.collect()] == [(None, "n")]
