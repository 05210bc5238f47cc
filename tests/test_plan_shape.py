"""Physical plans: no Python rows, no cross joins, filters at the scan, early pruning of ranks."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks.base import Star
from siftload.functions import dates
from siftload.operators import ranking

FOLDER = "/root/testdata/sf0.001"
BANNED = ["BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF"]
# A text operator of free style that looks line hashes up in Arrow batches; its texts stay on the JVM.
ARROW_BATCHES = {"op11_line_dedup": {"ArrowEvalPython"}}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(entry.queries()))
def test_no_python_rows_and_no_cross_joins(spark, key):
    plan = plan_of(entry.queries()[key](spark, FOLDER))
    assert not [word for word in BANNED if word in plan and word not in ARROW_BATCHES.get(key, ())]


@pytest.mark.parametrize("key", ["filter_date_cutoff", "filter_function_pred", "filter_between", "filter_implicit_cast", "filter_rolling_days"])
def test_filters_reach_the_scan(spark, key):
    plan = plan_of(entry.queries()[key](spark, FOLDER))
    pushed = plan[plan.index("PushedFilters:"):]
    assert any(word in pushed for word in ("GreaterThanOrEqual", "EqualTo"))


def test_scan_reads_only_used_columns(spark):
    plan = plan_of(entry.queries()["scan_table"](spark, FOLDER))
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string>" in plan


def test_first_per_group_is_pruned_before_the_shuffle(spark):
    orders = Star(spark, FOLDER).orders
    plan = plan_of(ranking.first_per_group(orders, ["o_custkey"], [F.col("o_orderdate").desc()]))
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_outer_join_made_inner(spark):
    plan = plan_of(entry.queries()["join_demoted_left"](spark, FOLDER))
    assert "LeftOuter" not in plan


def test_cutoff_literal_is_folded(spark):
    df = Star(spark, FOLDER).orders.where(F.col("o_orderdate") >= dates.ntz("2000-01-01"))
    assert "cast" not in plan_of(df).split("PushedFilters")[0].lower()


def test_small_merge_does_not_shuffle_the_target(spark):
    from siftload.sinks import merge

    star = Star(spark, FOLDER)
    target = star.orders.select("o_orderkey", "o_totalprice")
    source = target.limit(3)
    small = plan_of(merge.merge_upsert(target, source, ["o_orderkey"], source_rows=3))
    assert "SortMergeJoin" not in small and "FullOuter" not in small
