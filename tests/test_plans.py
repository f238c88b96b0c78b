"""Physical plans: what reaches the scan, and that nothing global runs over unaggregated rows."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tidewater.plans import registry
from tidewater.plans.events import revenue_by_key
from tidewater.plans.queries_events import event_rows
from tidewater.tables import Tables

FOLDER = "/root/testdata/sf0.001"


def test_filters_and_columns_reach_the_scan(spark, plan_of):
    plan = plan_of(contract.queries()["scan_parquet"](spark, FOLDER))
    assert "GreaterThan(o_totalprice,200000" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double>" in plan


def test_revenue_is_one_scan_with_partial_sums(spark, plan_of):
    df = revenue_by_key(event_rows(Tables(spark, FOLDER)))
    physical = plan_of(df).split("== Physical Plan ==")[1]
    assert physical.count("FileScan parquet") == 1
    assert physical.count("partial_sum") == 1 and physical.count("hashpartitioning") == 1
    assert "EqualTo(event_type,purchase)" in physical


@pytest.mark.parametrize("name", ["group_count_two_keys", "check_unique_key", "pivot_sum", "value_counts", "split_explode"])
def test_groups_are_combined_before_the_shuffle(spark, plan_of, name):
    assert re.search(r"partial_(count|sum)", plan_of(contract.queries()[name](spark, FOLDER)))


@pytest.mark.parametrize("name", ["reset_index", "slice_positions", "row_number_label", "ffill", "surrogate_key"])
def test_positions_use_no_global_window_over_rows(spark, plan_of, name):
    """Rows are numbered and filled within buckets; the only single-partition windows read one row per bucket."""
    physical = plan_of(contract.queries()[name](spark, FOLDER)).split("== Physical Plan ==")[1]
    windows = [line for line in physical.splitlines() if "Window [" in line]
    in_buckets = [line for line in windows if re.search(r"\], \[__bucket#\d+[,\]]", line)]
    assert in_buckets
    for line in windows:
        assert line in in_buckets or "size" in line or "reach" in line


def test_no_query_multiplies_tables(spark, plan_of):
    """Cartesian products only in the operator of that name; one-row results may be attached by a nested loop."""
    names = [n for n in registry.QUERIES if n.startswith(("describe", "summary", "scalar", "filter", "stack", "join", "semi", "check", "group", "pivot"))]
    for name in names:
        if "cross" not in name:
            assert "CartesianProduct" not in plan_of(contract.queries()[name](spark, FOLDER)), name


def test_reports_prune_the_partitioned_table(spark, plan_of, tmp_path):
    from tidewater.plans import queries_trips, trips

    reports = trips.run_trip_job(queries_trips.landed_feeds(Tables(spark, FOLDER)), str(tmp_path), queries_trips.YEARS)
    for name in ("growth", "by_year", "summary", "period_compare"):
        assert "PartitionFilters: [year" in plan_of(reports[name]).replace("isnotnull(year#", "year#").replace("[isnotnull(", "["), name


def test_not_in_can_shuffle(spark, plan_of):
    """Spark's own null-aware anti join always broadcasts the list; an ordinary join does not have to."""
    from tidewater.operators.joins import not_in

    left, listed = spark.range(100), spark.range(50).withColumnRenamed("id", "o")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = plan_of(not_in(left, listed, "id", "o"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
