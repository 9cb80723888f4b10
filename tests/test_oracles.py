"""Every catalogue query against SQL on the same tables."""

import os

import pytest
from oracle import differences

from __spark_entry__ import QUERIES, entry
from corpusloom.plans.oracles import ORACLES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    assert differences(df, ORACLES[name], SF_DIR) == []
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(join in plan for join in ("CartesianProduct", "BroadcastNestedLoopJoin"))


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0
