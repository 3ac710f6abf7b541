import re

import pytest

import __spark_entry__
from orestrata.llm import queries
from orestrata_checks.compare import connect, differences

SMALL = "/root/testdata/sf0.001"


def test_each_operator_has_one_query():
    names = [re.match(r"op(\d+)_", name) for name in __spark_entry__.queries()]
    assert sorted(int(m[1]) for m in names if m) == list(range(1, 14))
    assert "pipeline" in __spark_entry__.queries()
    assert queries.oracle_sql().keys() <= queries.queries().keys()


@pytest.mark.parametrize("name", queries.oracle_sql())
def test_query_equals_sql(spark, name):
    assert differences(queries.queries()[name](spark, SMALL), connect(SMALL), queries.oracle_sql()[name]) == []
