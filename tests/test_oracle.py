"""Every query that SQL can express gives the same rows as SQL."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from oracle import connection, difference

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
QUERIES, SQL = entry.sensor_queries(), entry.sensor_sql()
TREES = {"rf_scored", "gbt_scored"}


@pytest.fixture(scope="module")
def con():
    return connection(SF_DIR)


def test_only_tree_models_have_no_sql():
    assert set(QUERIES) - set(SQL) == TREES and set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_equals_sql(spark, con, key):
    df = QUERIES[key](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan
    assert difference(con, SQL[key], df) is None


@pytest.mark.parametrize("key", sorted(TREES))
def test_scored_rows_are_all_feature_rows(spark, key):
    sf_dir = "/root/testdata/sf0.001"
    scored = QUERIES[key](spark, sf_dir)
    assert scored.count() == entry.entry(spark).count() == 640
    assert scored.filter("predicted_pm25 IS NULL OR isnan(predicted_pm25)").isEmpty()
