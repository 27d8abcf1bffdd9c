import pytest
from helpers import connect, same_rows

from curata import catalogue

QUERIES, SQL = catalogue.queries(), catalogue.oracle_sql()


@pytest.fixture(scope="module")
def con(data):
    return connect(data)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, data, con, name):
    same_rows(QUERIES[name](spark, data), con, SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, data, name):
    df = QUERIES[name](spark, data)
    assert df.columns and df.count() >= 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert set(SQL) <= set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
