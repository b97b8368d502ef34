"""Every query against its SQL on the same tables."""

import __spark_entry__
import pytest
from compare import connect, difference

from clickloom.plans import catalog, oracles

QUERIES = catalog.queries()
ORACLES = oracles.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_same_as_sql(spark, sf_dir, con, name):
    assert difference(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None


def test_entry(spark, sf_dir):
    assert __spark_entry__.entry(spark).count() == 10
