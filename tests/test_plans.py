"""What the optimizer makes of the queries."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF

QUERIES = entry.queries()


def plan(spark, name):
    return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def optimized(spark, name):
    return QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()


def test_date_filter_and_columns_reach_the_scan(spark):
    text = plan(spark, "taxi_tip_share")
    assert "GreaterThanOrEqual(l_shipdate" in text
    read = text[text.index("ReadSchema") :].split("\n")[0]
    assert "l_partkey" not in read and "l_suppkey" not in read


def test_filters_of_the_query_reach_the_scan(spark):
    text = plan(spark, "filter_predicates")
    for part in ("GreaterThanOrEqual(l_quantity,10.0)", "In(l_linenumber", "GreaterThan(l_suppkey,3)"):
        assert part in text


@pytest.mark.parametrize("name", ["taxi_tip_share", "taxi_all_reports"])
def test_report_scans_once_and_counts_before_any_window(spark, name):
    text = plan(spark, name)
    if name == "taxi_tip_share":
        assert text.count("FileScan") == 1
    window, aggregate = text.index("Window"), text.index("HashAggregate")
    assert window < aggregate  # the window sits above the aggregate


# Joins with one row, or with a side whose size was checked before.
ONE_ROW = {"join_cross", "join_theta_range"}


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n.startswith(("taxi_", "join_", "agg_", "win_", "set_", "sort_"))))
def test_no_cartesian_product(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text
    if name not in ONE_ROW:
        assert "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n.startswith(("win_", "agg_", "udf_")) and n != "agg_skewed"))
def test_no_window_over_a_single_partition(spark, name):
    text = plan(spark, name)
    if "Window" in text:
        assert "SinglePartition" not in text


def test_group_limit_comes_before_the_shuffle(spark):
    text = plan(spark, "win_top_per_key")
    assert text.count("WindowGroupLimit") == 2
    assert text.rindex("WindowGroupLimit") > text.index("Exchange hashpartitioning")


def test_top_k_is_not_a_sort(spark):
    assert "TakeOrderedAndProject" in plan(spark, "top_k")


def test_bucketed_join_moves_nothing(spark):
    df = QUERIES["io_bucketed_write"](spark, SF)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text
    assert "Exchange" not in text.split("Initial Plan")[-1]


def test_small_side_is_broadcast(spark):
    assert "BroadcastHashJoin" in plan(spark, "join_broadcast")


def test_placement(spark):
    assert "hashpartitioning(l_orderkey" in plan(spark, "part_sort_within")
    text = plan(spark, "part_coalesce")
    assert "Coalesce" in text or "coalesce" in text.lower()
    assert "rangepartitioning(o_orderkey" in plan(spark, "part_range")


def test_folder_filter_prunes(spark):
    text = plan(spark, "io_partitioned_write")
    assert "PartitionFilters: [isnotnull(l_returnflag" in text


def test_aggregates_combine_before_the_shuffle(spark):
    for name in ("agg_basic", "ex_wordcount", "agg_skewed", "graph_degrees"):
        assert "partial_" in plan(spark, name)


def test_scalar_functions_stay_in_the_jvm(spark):
    for name in QUERIES:
        if name.startswith(("str_", "date_", "math_", "array_", "map_", "json_")):
            text = plan(spark, name)
            assert "Python" not in text and "Arrow" not in text
