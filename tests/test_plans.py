"""Physical plans: pushed filters, pruned columns, no single-task windows, no Python where none is due."""

import pytest
from conftest import DATA
from pyspark.sql import functions as F

from terrella import catalog
from terrella.operators import joins, ordering
from terrella.plans import rainfall, trips

QUERIES = catalog.queries()
#: Queries that fit models or write files while they are built.
EAGER = {
    "kmeans_fit", "pca_fit_transform", "rf_fit_predict", "gbt_fit_predict", "gbt_margin_predict", "mlp_fit_predict",
    "classifier_report", "model_save_load", "linear_regression_recovery",
}
PYTHON = {"udf_map_partitions", "udf_scalar_reduce", "knn_exact"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_query_funnels_rows_into_one_task(spark, name):
    text = plan(QUERIES[name](spark, DATA))
    assert "CartesianProduct" not in text
    lines = text.splitlines()
    for i, line in enumerate(lines):
        if "Window [" in line:
            # The window's own partition keys are the second bracket of the line.
            assert "Exchange SinglePartition" not in "".join(lines[i : i + 4]), text
    if name not in PYTHON:
        assert "Python" not in text and "Pandas" not in text


def test_filters_and_columns_reach_the_scan(spark, tables):
    text = plan(rainfall.station_year_totals(tables.obs))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in text
    scan = plan(tables.lineitem.filter("l_quantity > 49").select("l_orderkey"))
    assert "GreaterThan(l_quantity,49.0)" in scan and "struct<l_orderkey:bigint,l_quantity:double>" in scan


def test_trip_features_add_no_shuffle(tables):
    text = plan(trips.trip_features(tables.lineitem.selectExpr(
        "cast(l_shipdate as timestamp) as pickup_datetime", "cast(l_shipdate as timestamp) as dropoff_datetime",
        "l_linenumber as passenger_count", "l_tax as trip_distance", "l_tax as pickup_longitude",
        "l_tax as pickup_latitude", "l_partkey as rate_code", "l_tax as dropoff_longitude",
        "l_tax as dropoff_latitude", "l_extendedprice as fare_amount",
    )))
    assert "Exchange" not in text and "Python" not in text


def test_top_k_is_cut_before_the_shuffle(tables):
    text = plan(ordering.top_per_group(tables.lineitem, ["l_suppkey"], [F.desc("l_extendedprice")], 3))
    assert text.count("WindowGroupLimit") == 2


def test_near_centers_is_narrow(tables):
    text = plan(joins.near_centers(tables.stations, rainfall.CITIES, 25.0))
    assert "Join" not in text and "Exchange" not in text


def test_radius_pairs_use_an_equi_join(spark, tables):
    points = tables.stations.selectExpr("station_id as id", "longitude as lon", "latitude as lat")
    text = plan(joins.fixed_radius_pairs(points, 2.0))
    assert "NestedLoop" not in text and "CartesianProduct" not in text


def test_large_join_is_a_merge_join(spark):
    text = plan(QUERIES["join_shuffle_merge"](spark, DATA))
    assert "SortMergeJoin" in text and "Broadcast" not in text


def test_small_side_is_broadcast(spark):
    assert "BroadcastHashJoin" in plan(QUERIES["join_inner_broadcast"](spark, DATA))


def test_aggregates_combine_before_the_shuffle(spark):
    assert "partial_avg" in plan(QUERIES["group_mean"](spark, DATA))


def test_a_sweep_shuffles_once(spark):
    assert plan(QUERIES["focal_mean"](spark, DATA)).count("Exchange hashpartitioning") == 1
    assert plan(QUERIES["focal_mean_sweeps"](spark, DATA)).count("Exchange hashpartitioning") == 1
