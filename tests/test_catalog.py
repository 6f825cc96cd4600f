"""Every registered query on the smallest tables: equal to its SQL, or at least with rows."""

import pytest

from stayglass.catalog import QUERIES, SQL
from tests.check import compare, duck

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, FOLDER, name, QUERIES[name], SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_has_rows(spark, name):
    df = QUERIES[name](spark, FOLDER)
    assert df.count() > 0


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() == 1500
    assert contract.queries().keys() >= contract.oracle_sql().keys()
