"""Tables whose schema grows."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructType,
    TimestampType,
)

from martloom.sources import evolving
from martloom.sources.evolving import (
    SchemaConflict,
    append_evolved,
    extend_schema,
    merged,
    read_evolved,
    versions,
    wider,
)
from martloom.sources.tables import write_new


@pytest.mark.parametrize(
    "a, b, expected",
    [
        (IntegerType(), LongType(), LongType()),
        (LongType(), ByteType(), LongType()),
        (FloatType(), DoubleType(), DoubleType()),
        (IntegerType(), DoubleType(), DoubleType()),
        (LongType(), DoubleType(), None),
        (IntegerType(), FloatType(), None),
        (DecimalType(10, 2), DecimalType(8, 4), DecimalType(12, 4)),
        (DecimalType(38, 2), DecimalType(38, 4), None),
        (DecimalType(5, 2), IntegerType(), DecimalType(12, 2)),
        (DecimalType(5, 2), DoubleType(), None),
        (StringType(), IntegerType(), None),
        (DateType(), TimestampType(), None),
    ],
)
def test_widening_loses_nothing(a, b, expected):
    assert wider(a, b) == wider(b, a) == expected


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_three_versions_in_one_read(spark, tmp_path):
    path = str(tmp_path / "t")
    append_evolved(spark.createDataFrame([(1, "a"), (2, None)], "id int, v string"), path)
    second = spark.createDataFrame([("x", 3_000_000_000)], "w string, id long")
    append_evolved(second, path, defaults={"w": "'none'", "v": "'ignored: v is not new'"})
    third = spark.createDataFrame([(4, "d", "y", Decimal("1.50"))], "id short, V string, w string, n decimal(5,2)")
    assert append_evolved(third, path).number == 3
    read = read_evolved(spark, path)
    assert read.schema == StructType.fromDDL("id long, v string, w string, n decimal(5,2)")
    assert rows(read) == [
        (1, "a", "none", None), (2, None, "none", None), (3_000_000_000, None, "x", None),
        (4, "d", "y", Decimal("1.50")),
    ]
    # An append that lacks a column takes its default; one that has NULL keeps it.
    append_evolved(spark.createDataFrame([(5,)], "id int"), path)
    append_evolved(spark.createDataFrame([(6, None)], "id int, w string"), path)
    assert len(versions(spark, path)) == 3
    assert rows(read_evolved(spark, path).where("id > 4 AND id < 7").select("id", "w")) == [(5, "none"), (6, None)]


def test_filters_and_pruning_reach_every_version(spark, tmp_path):
    path = str(tmp_path / "t")
    append_evolved(spark.createDataFrame([(1, "a")], "id long, v string"), path)
    append_evolved(spark.createDataFrame([(2, "b", 1.0)], "id long, v string, x double"), path)
    plan = read_evolved(spark, path).where("v = 'a'").select("id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("EqualTo(v,a)") == 2 and "x:double" not in plan


def test_an_older_version_may_be_read(spark, tmp_path):
    path = str(tmp_path / "t")
    append_evolved(spark.createDataFrame([(1,)], "id int"), path)
    append_evolved(spark.createDataFrame([(2, "b")], "id long, v string"), path)
    assert rows(read_evolved(spark, path, 1)) == [(1,), (2,)]
    append_evolved(spark.createDataFrame([(2**40, "b")], "id long, v string"), path)
    with pytest.raises(Exception, match="does not fit id"):
        read_evolved(spark, path, 1).collect()
    with pytest.raises(SchemaConflict, match="no version 9"):
        read_evolved(spark, path, 9)


def test_what_files_could_not_be_read_by_is_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    append_evolved(spark.createDataFrame([(1, date(2026, 1, 1))], "id long, day date"), path)
    for wrong in ("id string", "id double", "id long, day timestamp", "id long, ID long"):
        with pytest.raises(SchemaConflict):
            append_evolved(spark.createDataFrame([], wrong), path)
    for wrong in ("id int, day date", "id long", "day date"):
        with pytest.raises(SchemaConflict, match="may not"):
            extend_schema(spark, path, StructType.fromDDL(wrong))
    assert len(versions(spark, path)) == 1 and read_evolved(spark, path).count() == 1
    extend_schema(spark, path, StructType.fromDDL("id decimal(20,0), day date, note string"))
    assert rows(read_evolved(spark, path)) == [(Decimal(1), date(2026, 1, 1), None)]


def test_a_repeated_append_replaces_its_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    one, two = (spark.createDataFrame([(i, "v")], "id int, v string") for i in (1, 2))
    append_evolved(one, path, token="a")
    append_evolved(two, path, token="b/ä = c")
    append_evolved(one, path, token="a")
    append_evolved(two, path, token="b/ä = c")
    assert rows(read_evolved(spark, path)) == [(1, "v"), (2, "v")]
    # Also when the schema has grown in between: nothing is left under the old one.
    append_evolved(one.withColumn("n", F.lit(7)), path, token="c")
    append_evolved(two, path, token="b/ä = c")
    append_evolved(one.limit(0), path, token="a")
    assert rows(read_evolved(spark, path)) == [(1, "v", 7), (2, "v", None)]


def test_a_failed_append_leaves_no_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    append_evolved(spark.createDataFrame([(1,)], "id int"), path)
    broken = spark.createDataFrame([(2, "b")], "id int, v string").withColumn("v", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        append_evolved(broken, path, token="x")
    assert rows(read_evolved(spark, path)) == [(1, None)]
    append_evolved(spark.createDataFrame([(2, "b")], "id int, v string"), path, token="x")
    assert rows(read_evolved(spark, path)) == [(1, None), (2, "b")]


def test_writers_at_once_and_broken_logs(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    append_evolved(spark.createDataFrame([(1,)], "id int"), path)
    # The first try meets another writer's version, which it then extends.
    tries = []

    def meddled(spark, target, text):
        if not tries:
            tries.append(target)
            monkeypatch.setattr(evolving, "write_new", write_new)
            append_evolved(spark.createDataFrame([(2, "x")], "id int, other string"), path)
            return write_new(spark, target, text)
        return write_new(spark, target, text)

    monkeypatch.setattr(evolving, "write_new", meddled)
    append_evolved(spark.createDataFrame([(3, 0.5)], "id int, mine double"), path)
    assert rows(read_evolved(spark, path)) == [(1, None, None), (2, "x", None), (3, None, 0.5)]
    # A log entry cut off in the middle does not count, nor block its number.
    write_new(spark, f"{path}/_schema/00000004.json", '{"schema": {"ty')
    append_evolved(spark.createDataFrame([(4, True)], "id int, late boolean"), path)
    assert [v.number for v in versions(spark, path)] == [1, 2, 3, 5]
    assert read_evolved(spark, path).where("late").count() == 1
    assert merged(StructType([]), StructType.fromDDL("a int NOT NULL")) == StructType.fromDDL("a int")


def test_no_table(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_evolved(spark, str(tmp_path / "none"))
    path = str(tmp_path / "empty")
    extend_schema(spark, path, StructType.fromDDL("id int"))
    assert read_evolved(spark, path).schema == StructType.fromDDL("id int")
    assert read_evolved(spark, path).isEmpty()
