"""Every registered query against its SQL."""

import os

import pytest

import __spark_entry__ as entry_point
from martloom.queries import ORACLES, QUERIES
from tests.oracle import connect, difference

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    with connect(SF_DIR) as connection:
        yield connection


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) == ""


def test_entry_returns_rows(spark):
    assert not entry_point.entry(spark).isEmpty()
