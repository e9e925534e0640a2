import pytest
from compare import assert_same, oracle

import __spark_entry__
from textloom.plans.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, sf, name):
    assert_same(QUERIES[name](spark, sf), oracle(sf, ORACLE_SQL[name]))


def test_entry(spark):
    assert __spark_entry__.entry(spark).columns == ["reason", "documents"]
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
