"""Every registered query against its SQL on the smallest scale."""

import pytest

from queries import all_queries
from tests.oracle import compare, connect

QUERIES, ORACLES = all_queries()


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, folder, con, name):
    assert compare(name, QUERIES[name](spark, folder), con, ORACLES[name]) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_returns_rows(spark, folder, name):
    assert QUERIES[name](spark, folder).count() > 0
