"""Every registered query against its SQL text on the test tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from check import connect, difference

from conftest import TESTDATA

pytestmark = pytest.mark.skipif(not os.path.isdir(TESTDATA), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(TESTDATA)


@pytest.mark.parametrize("name", contract.QUERIES)
def test_query_equals_sql(spark, con, name):
    df = contract.queries()[name](spark, TESTDATA)
    assert difference(df, con, contract.oracle_sql()[name]) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert unwanted not in plan


def test_every_query_has_sql():
    assert contract.QUERIES.keys() == contract.ORACLE.keys()


def test_entry_has_rows(spark):
    assert not contract.entry(spark).isEmpty()
