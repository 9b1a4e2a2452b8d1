"""Every registered query against its SQL, and the shape of its plan."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry
from catalog import ORACLE, QUERIES
from oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"



@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees_with_sql(spark, con, name):
    problem, _, _ = compare(spark, con, QUERIES[name], ORACLE[name], SF_DIR)
    assert problem is None


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith(("plan_", "st1_", "s4_"))])
def test_plan_has_no_cross_join_and_no_python(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert word not in plan


def test_entry(spark):
    rows = {r["status"]: r["count"] for r in entry.entry(spark).collect()}
    assert sum(rows.values()) == 50 and len(rows) > 1
