"""Queries that SQL can express, against it."""

import pytest

from compare import mismatch
from salesmill.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", SQL)
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_matches_sql(spark, name, sf):
    assert mismatch(spark, sf, QUERIES[name], SQL[name]) is None


def test_every_operator_is_registered_once():
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 14))
