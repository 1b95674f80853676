"""Plans: scans, shuffles, pushed filters. What holds here holds at any size."""

import re

import pytest

from periodgrid.operators import joins
from __spark_entry__ import queries
from periodgrid.plans.catalog import QUERIES


def static_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(plan, table):
    """File scans of a table; a reused exchange does not repeat its scan."""
    return len(re.findall(rf"FileScan parquet[^\n]*{table}\.parquet", plan))


@pytest.fixture(scope="module")
def plan_of(spark, sf_dir):
    registered = queries()
    return lambda name: static_plan(registered[name](spark, sf_dir))


def adaptive_plan(spark, sf_dir, name):
    """The plan as it ran, up to where the initial plan is printed once more."""
    df = queries()[name](spark, sf_dir)
    df.collect()
    return static_plan(df).split("== Initial Plan ==")[0]


def test_no_python_in_any_plan(plan_of):
    for name in QUERIES:
        if name not in {"refresh_inventory", "incremental_bronze", "xlsx_ingest_manifest", "xlsx_sheet_catalog"}:
            plan = plan_of(name)
            assert "Python" not in plan and "ArrowEval" not in plan, name


@pytest.mark.parametrize("name,table", [
    ("top_k_evolution", "lineitem"), ("top_k_groups", "lineitem"), ("dimension_dashboard", "orders"),
    ("vulnerability_index", "lineitem"), ("run_metrics_long", "orders"), ("run_compare", "orders"),
    ("completeness_months", "orders"), ("share_of_total", "lineitem"), ("group_gap", "lineitem"),
])
def test_facts_are_scanned_once(spark, sf_dir, name, table):
    assert scans(adaptive_plan(spark, sf_dir, name), table) == 1


@pytest.mark.parametrize("name", ["silver_clean", "silver_exclude_value", "silver_guarded_date",
                                  "severity_bands", "tolerant_number", "month_map_date", "lineage_columns"])
def test_row_wise_queries_do_not_shuffle(plan_of, name):
    assert "Exchange" not in plan_of(name)


def test_group_statistics_are_joined_without_moving_the_facts(plan_of):
    plan = plan_of("outlier_zscore")
    assert "BroadcastNestedLoopJoin" not in plan and "BroadcastHashJoin" in plan
    assert "Exchange hashpartitioning" not in plan


@pytest.mark.parametrize("name", ["top_k_groups", "top10_entities", "most_frequent_label", "first_values"])
def test_limits_do_not_sort_everything(plan_of, name):
    assert "TakeOrderedAndProject" in plan_of(name)


def test_large_statistics_are_not_copied(spark, sf_dir, monkeypatch):
    """Beyond the broadcast limit the small side moves once, and hot keys are left to Spark."""
    monkeypatch.setattr(joins.join_hot_keys, "__defaults__", (0,))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("rank_hot_values", "outlier_zscore"):
            plan = static_plan(queries()[name](spark, sf_dir))
            assert "Generate" not in plan and "SortMergeJoin" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_columns_are_pruned(plan_of):
    plan = plan_of("vulnerability_index")
    assert "ReadSchema: struct<l_quantity:double,l_returnflag:string>" in plan
    assert "PushedFilters: [In(l_returnflag" in plan


def test_point_lookup_reaches_below_the_aggregation(plan_of):
    assert "EqualTo(o_custkey,7)" in plan_of("point_lookup")


def test_no_window_without_partition_over_facts(plan_of):
    for name in ("rank_hot_values", "outlier_zscore", "share_of_total"):
        assert "cross" not in plan_of(name).lower()
        assert "CartesianProduct" not in plan_of(name)
