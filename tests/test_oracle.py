import pytest

import __spark_entry__ as contract
from tests.compare import connect, difference

QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, con, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), con, SQL[name]) is None


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert contract.entry(spark).count() > 0
