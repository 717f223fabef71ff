"""The physical plans hold no cross join, no per-row Python and no needless column."""

import re

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


OWN = {name for name in entry.queries() if not name.startswith("op") and name != "pipeline"}
NATIVE = sorted(OWN & set(entry.oracle_sql()))
#: Fits of trees and the search of hub bitmaps work on whole Arrow batches; row-at-a-time Python is out there as well.
BATCHED = {"friends_past_hubs", "boosting_second_order", "boosting_first_order", "adaboost_stumps", "extra_trees_nodes"}
BATCHED |= {name for name in NATIVE if name.endswith("_tested")}


@pytest.fixture
def written(monkeypatch, spark):
    """The plans of all tables that are written on the way to a result."""
    plans, frame = [], type(spark.range(1))
    write = frame.write.fget
    monkeypatch.setattr(frame, "write", property(lambda df: (df.isStreaming or plans.append(plan(df)), write(df))[1]))
    return plans


@pytest.mark.parametrize("name", NATIVE)
def test_no_python_and_no_cross_join(spark, written, name):
    result = entry.queries()[name](spark, SF)
    for text in [*written, plan(result)]:
        nodes = ("PythonUDF", "EvalPython", "CartesianProduct", "BroadcastNestedLoopJoin")
        for node in nodes if name in BATCHED else (*nodes, "InPandas", "InArrow"):
            assert node not in text, node


def test_scans_read_only_the_needed_columns(spark):
    text = plan(entry.queries()["ratings_dedup"](spark, SF))
    schemas = re.findall(r"ReadSchema: (.*)", text)
    assert any("l_quantity" in s and "l_tax" not in s and "l_comment" not in s for s in schemas)
    assert any(s.count(":") == 2 and "o_custkey" in s for s in schemas)


@pytest.mark.parametrize("name", ["mutual_friends", "cf_top_n", "profile_top_labels"])
def test_top_n_is_cut_before_the_shuffle(spark, name):
    assert "WindowGroupLimit" in plan(entry.queries()[name](spark, SF))


def test_top_itemsets_take_without_a_full_sort(spark):
    assert "TakeOrderedAndProject" in plan(entry.queries()["itemsets_top10"](spark, SF))
