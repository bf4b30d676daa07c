from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from martloom.operators.schema import columns
from martloom.sources import catalog
from martloom.sources.scratch import SETTING, scratch_dir
from martloom.sources.tables import (
    Table,
    append_rows,
    batch_slice,
    create_table,
    empty_rows,
    quarantine,
    read_table,
    replace_partition,
    replace_touched_partitions,
    seed_table,
    truncate_table,
)
from tests.test_merge import table as rows_of

T = Table(
    "t", columns(id="INT NOT NULL", v="STRING", org_code="STRING NOT NULL", batch_date="DATE NOT NULL"),
    ("org_code", "batch_date"),
)
D1, D2 = date(2026, 3, 31), date(2026, 4, 30)


def frame(spark, *rows):
    return spark.createDataFrame(rows, "id int, v string, org_code string, batch_date date")


def test_append_is_by_name(spark, tmp_path):
    root = str(tmp_path)
    create_table(spark, T, root)
    assert read_table(spark, T, root).count() == 0
    append_rows(frame(spark, (1, "a", "ail", D1)).select("v", "batch_date", "id", "org_code"), T, root)
    append_rows(frame(spark, (1, "a", "ail", D1), (2, None, "lnl", D2)), T, root)
    create_table(spark, T, root)
    assert rows_of(read_table(spark, T, root)) == [
        (1, "a", "ail", D1), (1, "a", "ail", D1), (2, None, "lnl", D2),
    ]
    with pytest.raises(Exception, match="NULL in id"):
        append_rows(frame(spark, (None, "a", "ail", D1)), T, root)


def test_a_load_replaces_its_own_partition_only(spark, tmp_path):
    root = str(tmp_path)
    own = {"org_code": "lnl", "batch_date": D1}
    append_rows(frame(spark, (1, "a", "ail", D1), (2, "b", "lnl", D1), (3, "c", "lnl", D2)), T, root)
    replace_partition(frame(spark, (9, "z", "lnl", D1)), T, root, own)
    assert rows_of(read_table(spark, T, root)) == [(1, "a", "ail", D1), (3, "c", "lnl", D2), (9, "z", "lnl", D1)]
    replace_partition(empty_rows(spark, T.schema), T, root, own)
    assert rows_of(read_table(spark, T, root)) == [(1, "a", "ail", D1), (3, "c", "lnl", D2)]
    replace_touched_partitions(frame(spark, (7, "q", "ail", D1)), T, root)
    assert rows_of(read_table(spark, T, root)) == [(3, "c", "lnl", D2), (7, "q", "ail", D1)]


def test_a_partition_may_be_replaced_from_itself(spark, tmp_path):
    root = str(tmp_path)
    append_rows(frame(spark, (1, "a", "ail", D1), (2, "b", "lnl", D1)), T, root)
    mine = batch_slice(read_table(spark, T, root), D1).where("org_code = 'ail'")
    replace_touched_partitions(mine.withColumn("v", F.upper("v")), T, root)
    assert rows_of(read_table(spark, T, root)) == [(1, "A", "ail", D1), (2, "b", "lnl", D1)]


def test_a_batch_slice_prunes_folders(spark, tmp_path):
    root = str(tmp_path)
    append_rows(frame(spark, (1, "a", "ail", D1), (2, "b", "lnl", D2)), T, root)
    sliced = batch_slice(read_table(spark, T, root), D2)
    assert len(sliced.inputFiles()) == 2 and rows_of(sliced) == [(2, "b", "lnl", D2)]
    plan = sliced._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch_date" in plan


def test_truncate_and_seed(spark, tmp_path):
    root = str(tmp_path)
    append_rows(frame(spark, (1, "a", "ail", D1)), T, root)
    truncate_table(spark, T, root)
    assert read_table(spark, T, root).count() == 0
    plain = Table("ref", columns(k="INT NOT NULL", v="STRING"))
    for _ in range(2):
        seed_table(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), plain, root)
    assert rows_of(read_table(spark, plain, root)) == [(1, "a"), (2, "b")]
    truncate_table(spark, plain, root)
    assert read_table(spark, plain, root).count() == 0


def test_quarantine_keeps_nulls(spark):
    df = spark.createDataFrame([(1, None, 'q"')], "a int, b string, c string")
    [row] = quarantine(df, "ail", D1, "basic", "why", datetime(2026, 3, 31, 6)).collect()
    assert row.raw_record == '{"a":1,"b":null,"c":"q\\""}'
    assert (row.org_code, row.batch_date, row.file_type, row.rejection_reason) == ("ail", D1, "basic", "why")


def test_catalog(spark, tmp_path):
    database = "mart_under_test"
    catalog.create_database(spark, database, str(tmp_path / "db"))
    assert database in catalog.list_databases(spark)
    plain = Table("ref", columns(k="INT NOT NULL", v="DECIMAL(12,2)"))
    for _ in range(2):
        catalog.create_tables(spark, database, [T, plain])
    assert catalog.list_tables(spark, database) == ["ref", "t"]
    name = catalog.quoted(database, "t")
    assert set(spark.table(name).columns) == {"id", "v", "org_code", "batch_date"}
    catalog.insert_rows(frame(spark, (1, "a", "ail", D1)).select("v", "id", "batch_date", "org_code"), database, T)
    assert rows_of(spark.table(name)) == [(1, "a", "ail", D1)]
    missing = Table("nothing", plain.schema)
    assert list(catalog.truncate_tables(spark, database, [missing, T])) == ["nothing"]
    assert spark.table(name).count() == 0
    catalog.insert_rows(frame(spark, (2, "b", "ail", D1)), database, T)
    catalog.recreate_tables(spark, database, [T])
    assert spark.table(name).count() == 0
    catalog.drop_database(spark, database)
    assert database not in catalog.list_databases(spark)


def test_scratch_is_the_shared_folder(spark):
    shared = spark.conf.get(SETTING)
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first.startswith(shared) and first != second
