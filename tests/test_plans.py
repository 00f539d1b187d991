"""Plan-shape checks for the scale properties the README promises."""

import pytest

from storelens.plans.registry import QUERIES

from conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_cartesian_product_or_python_udf(spark, key):
    plan = _plan(QUERIES[key](spark, SF_SMALL))
    assert "CartesianProduct" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_scan_reads_only_used_columns_and_pushes_filters(spark):
    plan = _plan(QUERIES["canceled_handed_to_carrier_share"](spark, SF_SMALL))
    scans = [line for line in plan.splitlines() if "lineitem" in line and "FileScan" in line]
    assert scans and all("EqualTo(l_linestatus,F)" in x for x in scans)
    for unused in ("l_extendedprice", "l_partkey", "l_quantity", "l_tax"):
        assert all(unused not in x.split("ReadSchema")[1] for x in scans)


def _executed(spark, df):
    """The plan of the query that was run, with adaptive changes."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_nested_loop_without_broadcasts(spark, key):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _executed(spark, QUERIES[key](spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "isFinalPlan=false" not in plan.split("\n")[0]
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def _counted(spark, key):
    """Line-item scans, shuffles and reused exchanges of the executed plan, broadcasts off."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _executed(spark, QUERIES[key](spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    final = plan.split("== Initial Plan ==")[0]
    lines = final.splitlines()
    return (sum("FileScan" in x and "lineitem.parquet" in x for x in lines),
            sum(" Exchange " in x for x in lines), sum("ReusedExchange" in x for x in lines))


def test_key_profile_scans_once(spark):
    scans, shuffles, _ = _counted(spark, "key_uniqueness_profile")
    assert scans == 1 and shuffles <= 2


@pytest.mark.parametrize("key", ["category_popularity", "rentals_by_actor_popularity_band",
                                 "rental_likelihood_by_category", "rental_likelihood_by_category_intended"])
def test_film_side_roles_share_one_aggregate_of_the_line_items(spark, key):
    scans, _, reused = _counted(spark, key)
    assert scans <= 2 and (reused > 0 or key == "category_popularity")


def test_second_gap_formulation_shuffles_little_more_than_the_first(spark):
    first, second = (_counted(spark, f"long_gap_nondelivered_share{v}")[1] for v in ("", "_v2"))
    assert second <= 1.5 * first


def test_item_features_share_one_window(spark):
    plan = _plan(QUERIES["item_prev_frame_stats"](spark, SF_SMALL))
    # besides the windows over the few buckets of large entities
    assert sum("row_number" in line for line in plan.splitlines() if "Window [" in line) == 1


def test_facts_aggregate_before_the_customer_join(spark):
    # orders are reduced per customer id (partial + final) before meeting customers
    plan = _plan(QUERIES["top_customer_by_orders"](spark, SF_SMALL))
    join_at = min(i for i in (plan.find("BroadcastHashJoin"), plan.find("SortMergeJoin")) if i >= 0)
    below = plan[join_at:]
    assert below.count("HashAggregate") >= 2
