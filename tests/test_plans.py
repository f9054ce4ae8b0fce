"""Plan properties every registered query must keep at any scale."""

import re

import pytest

from tessera.plans.registry import load_all

from .conftest import SMOKE_DIR

QUERIES = load_all()

# Un-partitioned windows are allowed only over results with a proven small
# bound: a top-10 (rank), five sample rows and the at most five valid review scores.
BOUNDED_WINDOW_QUERIES = {
    "top10_categories_share", "top10_report_text", "review_score_distribution", "source_samples",
}


def _executed_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()  # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: _executed_plan(q.fn(spark, SMOKE_DIR)) for name, q in QUERIES.items()}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_no_row_udf(plans, name):
    plan = plans[name]
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan  # no row-at-a-time Python UDFs
    assert "ArrowEvalPython" not in plan


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_unpartitioned_windows_only_when_bounded(plans, name):
    plan = plans[name]
    has_global_window = "Window [" in plan and re.search(r"Exchange SinglePartition", plan)
    if has_global_window and name not in BOUNDED_WINDOW_QUERIES:
        pytest.fail(f"{name}: window over a single partition")


def test_year_filter_reaches_scan(plans):
    plan = plans["revenue_by_category_year"]
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan


def test_scans_are_pruned(plans):
    # the per-movie average reads three lineitem columns, not all eleven
    plan = plans["avg_rating_by_movie"]
    m = re.search(r"ReadSchema: struct<(l_[^>]*)>", plan)
    assert m and len(m.group(1).split(",")) <= 3


def test_shared_total_computed_once(plans):
    # the top-10 share reads the category totals from a checkpoint instead of
    # re-running the lineitem/orders/part pipeline for its grand total
    plan = plans["top10_categories_share"]
    assert plan.count("lineitem.parquet") == 0


def test_aggregate_partitioning_reused_by_join(spark):
    """With the dimension too big to broadcast, the per-movie aggregate is
    joined on the partitioning it already has: one hash exchange on movie_id
    for the fact side (under the partial aggregate), one for the dimension."""
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        df = QUERIES["avg_rating_by_movie"].fn(spark, SMOKE_DIR)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "SortMergeJoin" in plan
    assert len(re.findall(r"Exchange hashpartitioning\(movie_id", plan)) == 2


# Partitions of a set size are the feature of one query; no other plan deals
# raw rows out round-robin.
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_round_robin(plans, name):
    if name != "packet_sized_partitions":
        assert "RoundRobinPartitioning" not in plans[name]


# A limit is allowed only where it is the feature: top-1, top-10, 5-row sample.
LIMIT_IS_THE_FEATURE = {
    "best_movie_min_support", "best_movie_out_of_reach", "top10_categories_share", "top10_subtotal_share",
    "top10_report_text", "top10_subtotal_text", "sample_rows", "source_samples",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_row_caps(plans, name):
    has_limit = bool(re.search(r"(GlobalLimit|LocalLimit|CollectLimit|TakeOrderedAndProject|\bLimit\b)", plans[name]))
    if name not in LIMIT_IS_THE_FEATURE:
        assert not has_limit, f"{name} caps rows"
