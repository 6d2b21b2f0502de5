"""Plan-shape guards: the properties the scale design relies on, checked on executed plans."""

import re

import pytest

from donorlens.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "MapInArrow", "PythonMapInArrow")
# queries that read the orders table twice by design: paid orders + the activity stream (LTV),
# or two loads of the same table (keyed loads)
TWO_ORDER_SCANS = {"ltv_cohorts", "ltv_cumulative", "ltv_long", "revenue_long", "ltv_cum_long"}


def _final_plan(df) -> str:
    df.collect()
    s = df._jdf.queryExecution().executedPlan().toString()
    return s.split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_no_python_and_one_scan(spark, name):
    plan = _final_plan(QUERIES[name](spark, SF))
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op}"
    orders_scans = len(re.findall(r"FileScan parquet \[o_", plan))
    if name in TWO_ORDER_SCANS:
        assert orders_scans == 2, name
    elif name not in ("upsert_by_key", "insert_ignore_by_key"):
        assert orders_scans <= 1, f"{name}: {orders_scans} scans of orders"


def test_grid_is_partially_aggregated_before_the_shuffle(spark):
    plan = QUERIES["donor_month_grid"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    # the shuffle is keyed by (customer, month) and fed by a partial (map-side) aggregate
    assert re.search(r"Exchange hashpartitioning\(customer_id#\d+L?, (month|_groupingexpression)#\d+", plan)
    assert re.search(r"HashAggregate\(keys=\[customer_id#\d+L?, (month|_groupingexpression)#\d+\], "
                     r"functions=\[partial_count", plan)


def test_status_filter_and_columns_reach_the_scan(spark):
    from donorlens.plans.catalog import RAW
    df = RAW["cohort_revenue_arppu"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)" in plan
    scan = re.search(r"ReadSchema: (struct<[^>]*>)", plan).group(1)
    assert "o_orderpriority" not in scan


def test_pipeline_marts_read_the_materialised_grid_not_the_orders(spark):
    """After build_plan, only the paid-orders extract reads the orders table; the all-user cohorts
    read the activity stream (here: orders of any status); every other mart reads the
    materialised grid or the months-sized tables derived from it."""
    from donorlens.plans.marts import MartPlan
    from donorlens.plans.pipeline import build_plan
    from donorlens.sources.tables import TPCH_PAID_STATUS, orders_from_tpch, read_table
    orders = orders_from_tpch(read_table(spark, SF, "orders"))
    plan = build_plan(spark, orders, "2001-08-01", TPCH_PAID_STATUS, None)
    for name in MartPlan.MART_NAMES:
        text = getattr(plan, name)()._jdf.queryExecution().executedPlan().toString()
        scans_orders = "orders.parquet" in text
        assert scans_orders == (name in ("paid_only", "cohorts_all")), name


def test_slot_months_are_filtered_in_the_scan_of_the_stored_grid(spark):
    plan = QUERIES["cohort_revenue_slots"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    pushed = re.findall(r"PushedFilters: \[([^\n]*)", plan)
    assert any("GreaterThanOrEqual(month,2000-09-01)" in p and "LessThanOrEqual(month,2001-08-01)" in p for p in pushed), pushed


def test_rfm_reads_the_orders_once_with_one_shuffle_by_customer(spark):
    plan = _final_plan(QUERIES["rfm_segments"](spark, SF))
    assert len(re.findall(r"- FileScan parquet \[o_", plan)) == 1
    assert len(re.findall(r"- Exchange hashpartitioning\(customer_id", plan)) == 1 and "ReusedExchange [customer_id" in plan
