"""Profiles of parts add up to those of the whole."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martloom.operators.profile import (
    kept_profiles,
    merged,
    profile,
    profile_new_parts,
    readable,
)

SCHEMA = "id long, name string, day date, amount decimal(12,2), flag boolean"
COLUMNS = ["id", "name", "day", "amount", "flag"]


def rows(n, start=0):
    return [
        (
            i,
            None if i % 7 == 0 else f"name {i % 50}",
            date(2026, 1 + i % 12, 1),
            None if i % 3 else Decimal(i) / 4 - 100,
            i % 2 == 0,
        )
        for i in range(start, start + n)
    ]


def plain(values):
    out = {}
    for j, name in enumerate(COLUMNS):
        column = [r[j] for r in values]
        present = [v for v in column if v is not None]
        out[name] = (len(column), len(column) - len(present), min(present, default=None), max(present, default=None), len(set(present)))
    return out


def shown(df):
    out = {}
    for r in readable(df).collect():
        number = r.column_name in ("id", "amount")
        out[r.column_name] = (
            r.n_rows, r.n_nulls, r.least_number if number else r.least, r.greatest_number if number else r.greatest, r.approx_distinct,
        )
    return out


def as_text(value):
    return value if value is None or not isinstance(value, (date, bool)) else str(value).lower() if isinstance(value, bool) else str(value)


def check(found, values):
    expected = plain(values)
    assert found.keys() == expected.keys()
    for name, (n, nulls, least, greatest, distinct) in expected.items():
        got = found[name]
        assert got[:4] == (n, nulls, as_text(least), as_text(greatest))
        assert abs(got[4] - distinct) <= 0.05 * distinct


@pytest.mark.parametrize("cuts", [[0, 3000], [0, 1, 1, 1500, 3000]])
def test_parts_add_up(spark, cuts):
    values = rows(3000)
    parts = [profile(spark.createDataFrame(values[a:b], SCHEMA), COLUMNS) for a, b in zip(cuts, cuts[1:])]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    check(shown(merged(whole)), values)


def test_nothing_and_only_nulls(spark):
    empty = spark.createDataFrame([], SCHEMA)
    nulls = spark.createDataFrame([(None,) * 5] * 4, SCHEMA)
    check(shown(profile(empty, COLUMNS)), [])
    check(shown(merged(profile(empty, COLUMNS).unionByName(profile(nulls, COLUMNS)))), [(None,) * 5] * 4)
    with pytest.raises(TypeError, match="has no profile"):
        profile(empty.withColumn("x", F.lit(1.5)), ["x"])


def test_one_pass(spark):
    plan = profile(spark.createDataFrame(rows(5), SCHEMA), COLUMNS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1


def test_only_new_parts_are_read(spark, tmp_path):
    kept, parts = str(tmp_path / "profiles"), {}
    for i in range(3):
        name = f"2026-0{i + 1} / ä"
        parts[name] = str(tmp_path / f"rows{i}")
        spark.createDataFrame(rows(100, 100 * i), SCHEMA).write.parquet(parts[name])
    schema = spark.createDataFrame([], SCHEMA).schema
    first = dict(list(parts.items())[:2])
    assert profile_new_parts(spark, first, schema, COLUMNS, kept) == sorted(first)
    # What has a profile is not read again, not even if it is gone.
    gone = {name: str(tmp_path / "nowhere") for name in first} | {n: f for n, f in parts.items() if n not in first}
    assert profile_new_parts(spark, gone, schema, COLUMNS, kept) == sorted(set(parts) - set(first))
    assert profile_new_parts(spark, gone, schema, COLUMNS, kept) == []
    check(shown(merged(kept_profiles(spark, kept))), rows(300))
    check(shown(merged(kept_profiles(spark, kept, list(first)))), rows(200))
    assert kept_profiles(spark, str(tmp_path / "none")).isEmpty()
