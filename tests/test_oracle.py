"""Every core query against its SQL on the smallest tables."""

import pytest

from tests.compare import connection, difference
from undertone.plans import catalogue

QUERIES, SQL = catalogue.queries(), catalogue.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return connection(sf)


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, sf, con, name):
    more, less = difference(QUERIES[name](spark, sf), con, SQL[name])
    assert not more and not less


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, sf, name):
    assert QUERIES[name](spark, sf).count() >= 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
