"""Plan tests: pushdown, pruning, no Python evaluation, equality keys in joins."""

import re

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    ["p2_select", "p7_filter_compare", "g3_edge_counts", "x1_tokenize", "a1_group_count", "e1_binary_metrics",
     "f6_standard_scale", "o4_topk_per_group", "l5_timestamp_parse", "a5_quantiles", "a7_label_frequency", "x5_count_vectors",
     "x6_tf_idf", "f17_contingency", "f17_chi2_select", "g7_pagerank", "j3_soon_after"],
)
def test_no_python_evaluation(spark, name):
    plan = _plan(entry.queries()[name](spark, SF))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "MapInArrow"):
        assert node not in plan, name


def test_filter_and_projection_reach_the_scan(spark):
    df = entry.queries()["p7_filter_compare"](spark, SF)
    text = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    pushed = [line for line in text.splitlines() if "PushedFilters" in line][0]
    assert "LessThan(l_quantity,10.0)" in pushed and "Or(EqualTo(l_returnflag,R)" in pushed
    p2 = entry.queries()["p2_select"](spark, SF)
    p2_text = p2._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in p2_text


def test_timed_cycles_join_on_item(spark):
    df = entry.queries()["g6_timed_cycles"](spark, SF)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join Inner" in line]
    keyed = [line for line in joins if re.search(r"\(__k\d_item#\d+L? = __k\d_item#\d+L?\)", line)]
    assert len(keyed) == 2, joins  # the second and the third trip meet the others on the item
    executed = _plan(df)
    assert "CartesianProduct" not in executed and "BroadcastNestedLoopJoin" not in executed
