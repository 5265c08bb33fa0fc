"""Plan guards over every registered query: JVM-side expressions, no cross
joins, no row caps, whole tables."""

import pytest

TABLE_DIR = "/root/testdata/sf0.001"


def _keys():
    from tidylake.plans.acceptance import QUERIES
    return list(QUERIES)


@pytest.mark.parametrize("key", _keys())
def test_plan_guards(spark, key):
    from __spark_entry__ import queries
    df = queries()[key](spark, TABLE_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas"):
        assert node not in plan, f"{key}: row/group Python in plan"
    if key != "html_table_extract":
        assert "MapInPandas" not in plan
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan, f"{key}: cross join"
    for node in ("GlobalLimit", "CollectLimit", "LocalLimit", "Sample"):
        assert node not in plan, f"{key}: row cap"
