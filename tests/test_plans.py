"""Plan shape guards: pruning, pushdown and shuffle counts of the driver
queries stay what the design says."""

import re

import pytest

from trailmark.plans import events as E

SF = "/root/testdata/sf0.001"


def _plan(spark, name):
    return E.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def _shuffles(plan):
    return len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition)", plan))


@pytest.mark.parametrize("name", ["hot_items_counts", "hot_urls_counts"])
def test_sliding_counts_never_expand_rows(spark, name):
    plan = _plan(spark, name)
    assert "Expand" not in plan
    assert _shuffles(plan) == 2
    assert re.search(r"ReadSchema: struct<ts:timestamp_ntz,user_id:bigint(,event_type:string)?>",
                     plan)


def test_view_filter_reaches_scan(spark):
    assert "EqualTo(event_type,view)" in _plan(spark, "hot_items_counts")


def test_strict_next_partitions_by_key_and_block(spark):
    plan = _plan(spark, "login_fail_pairs")
    assert _shuffles(plan) == 1
    assert re.search(r"Exchange hashpartitioning\(user_id#\d+L, _blk#\d+L", plan)


def test_followed_by_shuffles_events_once(spark):
    plan = _plan(spark, "order_results")
    # the events with the told rows, the partial summary, and the summary by key and stretch
    assert _shuffles(plan) == 3
    # only summary rows are copied ahead, never events
    copied = [line for line in plan.splitlines() if "Generate" in line]
    assert len(copied) == 1 and "_cand" in copied[0] and "event_id" not in copied[0]
    assert len(re.findall(r"Exchange hashpartitioning\(user_id#\d+L, _blk#\d+L", plan)) == 3


def test_running_count_shuffles_events_once(spark):
    plan = _plan(spark, "running_unique_visitors")
    # REPARTITION_BY_COL: the only exchange that holds events; the bounds reach them by broadcast,
    # no other join reads them
    assert plan.count("REPARTITION_BY_COL") == 1 and "SortMergeJoin" not in plan
    assert all("[window_end#" in line and "_slice#" in line for line in plan.splitlines() if "Join" in line)


def test_topn_has_partial_group_limit(spark):
    plan = _plan(spark, "hot_items_topn")
    assert "WindowGroupLimit" in plan


def test_reconcile_is_an_outer_and_an_anti_join(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(spark, "tx_reconcile")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "LeftOuter" in plan and "LeftAnti" in plan and "FullOuter" not in plan
    assert "Window" not in plan and _shuffles(plan) == 4


def test_distinct_count_shuffles_on_window_and_user_first(spark):
    plan = _plan(spark, "unique_visitors")
    assert re.search(r"Exchange hashpartitioning\(window_end#\d+L, _u#\d+L", plan)


def test_dense_aggregate_shuffles_pane_states_only(spark):
    """120 windows overlap a row: rows are aggregated in their pane before
    anything is expanded, two copies of a state reach the blocks."""
    plan = _plan(spark, "window_aggregate_dense")
    scan = plan.index("FileScan")
    below = plan[plan.rindex("Generate", 0, scan):scan]
    assert below.count("HashAggregate") >= 2 and _shuffles(plan) == 2
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string,value:double>" in plan
