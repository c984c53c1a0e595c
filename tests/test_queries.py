"""Every registered query against its SQL on the smallest data."""

import pytest

from compare import mismatch
from salesmill.workload import everything

QUERIES, SQL = everything()


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, name):
    assert mismatch(spark, "sf0.001", QUERIES[name], SQL.get(name)) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
