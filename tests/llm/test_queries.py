"""Queries against their SQL, and what all of them have in common."""

import pytest

from martloom.llm import ORACLES, QUERIES
from tests.oracle import difference


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_sql(spark, con, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), con, ORACLES[name]) == ""


def test_every_number_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
