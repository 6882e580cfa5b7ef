"""Operators that promise DataFrame functions alone have no Python in their plans."""

import pytest

import __spark_entry__ as entry

from conftest import DATA


@pytest.mark.parametrize("name", ["op4_secret_scan", "op9_quality_rules", "op12_order_minhash"])
def test_native_operators_stay_in_the_jvm(spark, name):
    text = entry.queries()[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Arrow", "InPandas"):
        assert node not in text
