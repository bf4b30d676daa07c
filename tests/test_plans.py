"""The physical plans the operators are meant to have at scale."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from martloom.operators.append import new_facts
from martloom.operators.merge import Scd1, Scd2, scd1_upsert, scd2_merge
from martloom.operators.quality import fact_dim_join, orphans
from martloom.operators.schema import columns
from martloom.operators.skew import lookup_join
from martloom.plans.policy_mart import CONTRACTS
from martloom.plans.staging import stage
from martloom.queries import QUERIES
from martloom.sources import catalog
from martloom.sources.delimited import scan_delimited
from martloom.sources.tables import slices_named_in

DAY = date(2026, 3, 31)
DIM = columns(
    k="BIGINT", v="STRING", is_current="BOOLEAN", effective_date="DATE", end_date="DATE",
    created_date="DATE", updated_date="DATE",
)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def dim(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("dim") / "d")
    spark.range(1000).select(
        F.col("id").alias("k"), F.lit("a").alias("v"), (F.col("id") % 2 == 0).alias("is_current"),
        *[F.lit(DAY).alias(c) for c in ("effective_date", "end_date", "created_date", "updated_date")],
    ).write.parquet(path)
    return spark.read.schema(DIM).parquet(path)


@pytest.fixture(scope="module")
def batch(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("batch") / "b")
    spark.range(0, 2000, 7).select(F.col("id").alias("k"), F.lit("b").alias("v")).write.parquet(path)
    return spark.read.parquet(path)


def test_loading_is_one_narrow_stage(spark, tmp_path):
    contract = CONTRACTS["basic"].for_org("ail")
    path = tmp_path / "a.csv"
    path.write_text(",".join(contract.names) + "\n")
    rows = scan_delimited(spark, str(path), contract)
    for part in stage(rows, contract, DAY, datetime(2026, 3, 31)):
        plan = plan_of(part)
        assert "Exchange" not in plan and "Python" not in plan and plan.count("FileScan") == 1
        assert "gender" not in plan_of(stage(rows, contract, DAY, datetime(2026, 3, 31))[0])


def exchanges(plan):
    return plan.count("Exchange hashpartitioning")


def test_a_small_batch_does_not_shuffle_the_dimension(dim, batch):
    spec = Scd2(keys=("k",), tracked=("v",))
    plan = plan_of(scd2_merge(dim, batch, spec, DAY, DAY, broadcast_source=True))
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 3
    # The one shuffle is that of the keys met, after the semi join.
    assert exchanges(plan) == 1 and "LeftSemi" in plan
    upsert = scd1_upsert(
        dim, batch, Scd1(keys=("k",), attributes=("v",)), DAY, broadcast_source=True
    )
    assert "SortMergeJoin" not in plan_of(upsert)


def test_a_big_batch_shuffles_each_side_once(dim, batch):
    spec = Scd2(keys=("k",), tracked=("v",))
    plan = plan_of(scd2_merge(dim, batch, spec, DAY, DAY, broadcast_source=False))
    assert plan.count("FullOuter") == 1 and exchanges(plan) == 2
    # Current and closed versions are told apart in the scan.
    assert "PushedFilters: [IsNotNull(is_current), EqualTo(is_current,true)]" in plan


def test_facts_are_read_on_keys_and_not_shuffled(dim, batch):
    plan = plan_of(new_facts(batch, dim, ["k"], broadcast_keys=True))
    assert "SortMergeJoin" not in plan and "ReadSchema: struct<k:bigint>" in plan


def test_orphans_count_before_they_shuffle(spark, dim, batch):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(orphans(batch, dim, ["k"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.index("LeftAnti") < plan.index("partial_count(1)")


def test_facts_meet_in_one_anti_join(dim, batch):
    plan = plan_of(new_facts(batch, dim, ["k"], broadcast_keys=False))
    assert plan.count("Join") == 1 and "SortMergeJoin" in plan and "LeftAnti" in plan
    assert plan.count("FileScan") == 2 and "ReadSchema: struct<k:bigint>" in plan


def test_a_lookup_that_must_not_be_broadcast_is_not(dim, batch):
    plan = plan_of(lookup_join(batch, dim.select("k", "is_current"), ["k"], broadcast_right=False))
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    # Hot keys, here all of them, are joined by broadcast beside the rest.
    plan = plan_of(lookup_join(batch, dim.select("k", "is_current"), ["k"], broadcast_right=False, hot_rows=1))
    assert "SortMergeJoin" in plan and plan.count("BroadcastHashJoin") >= 3


@pytest.mark.parametrize("name", ["append_new_facts_shuffled", "fact_dim_join_hot_keys"])
def test_queries_run_the_plan_they_are_named_for(spark, name):
    assert "SortMergeJoin" in plan_of(QUERIES[name](spark, "/root/testdata/sf0.001"))


def test_bucketed_tables_meet_without_a_shuffle(spark, tmp_path, dim):
    catalog.create_database(spark, "bucketed", str(tmp_path / "db"))
    try:
        rows = spark.range(0, 3000, 2).select(F.col("id").alias("k"), F.lit("b").alias("note"))
        facts = catalog.write_bucketed(rows, "bucketed", "facts", ["k"], 4)
        versions = catalog.write_bucketed(dim, "bucketed", "dim", ["k"], 4)
        joined = fact_dim_join(facts, versions, ["k"], ["v"], broadcast_right=False)
        plan = plan_of(joined)
        assert "SortMergeJoin" in plan and "Exchange" not in plan and plan.count("Bucketed: true") == 2
        assert joined.count() == 500
    finally:
        catalog.drop_database(spark, "bucketed")


def test_batches_named_by_a_table_prune_the_scan_when_it_runs(spark, tmp_path):
    path = str(tmp_path / "facts")
    spark.range(100).selectExpr("id", "id % 10 AS batch").write.partitionBy("batch").parquet(path)
    spark.range(10).selectExpr("CAST(id AS INT) AS batch", "100 - id AS rank").write.parquet(str(tmp_path / "list"))
    wanted = spark.read.parquet(str(tmp_path / "list")).where("rank < 93")
    found = slices_named_in(spark.read.parquet(path), wanted, ["batch"])
    assert "dynamicpruning" in plan_of(found) and "left_semi" not in plan_of(found)
    assert sorted(r.batch for r in found.select("batch").distinct().collect()) == [8, 9]
