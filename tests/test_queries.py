"""Every query beside its SQL on the small tables, and what no plan may contain."""

import os

import pytest

import __spark_entry__ as driver
from oracle import compare, connect, types
from tidemark.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = driver.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    sql = driver.oracle_sql()[name]
    assert compare(df, con, sql) == ""
    assert types(df, con, sql) == ""


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == ["symbol", "ts", "risk_score"] and df.count() == 15
