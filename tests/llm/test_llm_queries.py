import pytest
from helpers import connect, same_rows

from curata.llm import queries

QUERIES, SQL = queries.queries(), queries.oracle_sql()


@pytest.fixture(scope="module")
def con(data):
    return connect(data)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, data, con, name):
    same_rows(QUERIES[name](spark, data), con, SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, data, name):
    n = QUERIES[name](spark, data).count()
    assert n > 0 or name == "p2_paraphrases"  # the smallest data have none
