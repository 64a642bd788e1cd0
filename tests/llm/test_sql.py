import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parents[1])]

from oracle import connect, differences

from pagelens.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    assert not differences(connect(SF), queries.oracle_sql()[name], queries.queries()[name](spark, SF))
