"""Plan shape of every registered query: no cross joins and no
Python anywhere."""

import pytest

import __spark_entry__ as E
from sitelens.plans.registry import REGISTRY

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_plan_shape(spark, name):
    plan = E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
    has_python = any(k in plan for k in ("MapInPandas", "ArrowEval", "BatchEvalPython", "PythonUDF"))
    assert not has_python


def test_filters_reach_the_scan(spark):
    plan = E.queries()["clean_sites"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,O)]" in plan
    plan = E.queries()["facet_counts"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<lang:string,source:string>" in plan


def test_null_keys_are_not_shuffled(spark):
    from sitelens.operators import join
    left = spark.range(1000).selectExpr("if(id % 2 = 0, null, cast(id % 50 as string)) as k", "id")
    right = spark.range(50).selectExpr("cast(id as string) as k", "id * 2 as v")
    for df, n in ((join.enrich_left(left, right, "k"), 1000), (join.unmatched(left, right, "k"), 500)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "isnull(" in plan and "isnotnull(" in plan and "Union" in plan
        assert df.count() == n


def test_number_filters_reach_the_scan(spark):
    from sitelens.plans import standins
    plan = standins.table(spark, SF, "customer").filter("c_acctbal > 100")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(c_acctbal,100.0)" in plan
