import pytest
from oracle import connect, differences

from pagelens.plans import queries

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, con, name):
    assert not differences(con, queries.oracle_sql()[name], queries.queries()[name](spark, SF))


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - set(queries.oracle_sql())))
def test_other_queries_run(spark, name):
    assert queries.queries()[name](spark, SF).count() > 0
