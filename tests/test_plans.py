"""The plans are the ones wanted: pruned scans, small sides broadcast, no Python."""

import pytest

import __spark_entry__ as entry
from ledgerlens.operators.lookup import attach_group, map_values
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"
# queries that work on Arrow batches by design
PYTHON = {
    "knn_neighbours", "knn_classify", "knn_blocks", "knn_hashed_recall", "permutation_importance",
    "op9_projection_passes", "op11_fixed_block_anchors", "op12_permuterm_variants", "op13_angular_negatives",
}


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - PYTHON))
def test_no_python_and_no_cartesian(spark, name):
    plan = physical(entry.queries()[name](spark, SMALL))
    for bad in ("Python", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = physical(entry.queries()["self_join_views"](spark, SMALL))
    assert "EqualTo(l_returnflag,A)" in plan and "l_suppkey" not in plan


def test_small_lookups_are_broadcast_without_a_hint(spark):
    orders = spark.read.parquet(f"{SMALL}/orders.parquet")
    mapping = spark.createDataFrame([("a", "1-URGENT", 1.0, "U")], "r string, k string, n double, v string")
    plan = physical(map_values(orders, "o_orderpriority", mapping, "k", "v", "g"))
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    plan = physical(attach_group(orders, "o_orderstatus", {"first": F.min("o_orderdate")}))
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_big_lookups_are_not_broadcast(spark):
    orders = spark.read.parquet(f"{SMALL}/orders.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        plan = physical(attach_group(orders, "o_custkey", {"first": F.min("o_orderdate")}))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan


@pytest.mark.parametrize("name", ["thin_recent", "yearly_repeat_summary"])
def test_thinning_shuffles_the_rows_once(spark, name):
    df = entry.queries()[name](spark, SMALL)
    df.collect()
    final = physical(df).split("Initial Plan")[0]
    assert "ReusedExchange" in final and final.count("FileScan") == 1
