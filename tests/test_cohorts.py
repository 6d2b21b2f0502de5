"""Cohort slot marts (M-05..M-15) and the unpivots (T-01..T-07)."""

import datetime as dt

from pyspark.sql import functions as F

from donorlens.functions.timecols import add_months_py, slot_months
from donorlens.operators import base, cohorts, reshape
from donorlens.plans.marts import MartPlan
from donorlens.sources.tables import activity_from_orders


def test_slot_month_on_the_31st_clamps():
    assert slot_months(dt.date(2024, 3, 31), 3) == [dt.date(2024, 3, 1), dt.date(2024, 2, 1), dt.date(2024, 1, 1)]
    assert add_months_py(dt.date(2024, 1, 31), -13) == dt.date(2022, 12, 1)


def _plan(orders, as_of, activity=None):
    return MartPlan(orders, as_of=as_of, activity=activity)


def test_empty_slot_zero_vs_null(orders_df):
    # cohort 2024-01 (two customers); only customer 1 pays again in 2024-03; as-of 2024-03-31
    orders = orders_df([(1, 1, "Paid", "2024-01-05 10:00", 100), (2, 2, "Paid", "2024-01-06 10:00", 50),
                        (1, 3, "Paid", "2024-03-02 10:00", 30), (1, 4, "Paid", "2024-03-09 10:00", 31)])
    p = _plan(orders, "2024-03-31")
    ra = p.cohorts_revenue_arppu_data().collect()[0]
    assert ra["total_users"] == 2
    assert float(ra["revenue_month_1"]) == 61.0 and float(ra["arppu_month_1"]) == 30.5
    assert float(ra["revenue_month_2"]) == 0.0 and float(ra["arppu_month_2"]) == 0.0   # Feb: empty -> 0
    assert float(ra["revenue_month_3"]) == 150.0
    rr = p.rr_cohorts().collect()[0]
    assert rr["cohort"] == "2024-01"
    assert float(rr["RR Month 3"]) == 100.0 and float(rr["RR Month 2"]) == 0.0 and float(rr["RR Month 1"]) == 50.0
    ac = p.ac_cohort().collect()[0]
    assert ac["average_check_month_1"] is None                      # Feb: no order -> NULL
    assert float(ac["average_check_current_month"]) == 30.5
    assert float(ac["average_check_month_2"]) == 75.0
    cum = p.arppu_cumulative().collect()[0]
    assert float(cum["cumulative_arppu_1"]) == round((150 + 61) / 2, 2)
    assert float(cum["cumulative_arppu_3"]) == 75.0


def test_ltv_mixes_first_action_and_first_payment_cohorts(spark, orders_df):
    # user 1 acts in 2024-01 (unpaid order) and pays first in 2024-02
    orders = orders_df([(1, 1, "Pending", "2024-01-10 10:00", 10), (1, 2, "Paid", "2024-02-10 10:00", 40),
                        (2, 3, "Paid", "2024-02-11 10:00", 20)])
    p = _plan(orders, "2024-02-29", activity=activity_from_orders(orders))
    ltv = {r["cohort_month"]: r for r in p.ltv_cohorts().collect()}
    # all-user cohorts: 2024-01 (user 1), 2024-02 (user 2); paid revenue sits in cohort 2024-02
    assert ltv[dt.date(2024, 1, 1)]["total_users"] == 1
    assert float(ltv[dt.date(2024, 1, 1)]["revenue_month_1"]) == 0.0
    assert ltv[dt.date(2024, 2, 1)]["total_users"] == 1
    assert float(ltv[dt.date(2024, 2, 1)]["revenue_month_1"]) == 60.0
    assert float(ltv[dt.date(2024, 2, 1)]["ltv_month_1"]) == 60.0
    cum = {r["cohort_month"]: r for r in p.cumulative_ltv().collect()}
    assert float(cum[dt.date(2024, 2, 1)]["ltv_cumulative_1"]) == 60.0


def test_cohort_sizes_sum_to_paying_customers(spark):
    from donorlens.plans.catalog import _plan as tplan
    p = tplan(spark, "/root/testdata/sf0.001")
    sizes = base.cohort_sizes(base.paid_cohorts(p.donor_grid)).agg(F.sum("total_users")).first()[0]
    payers = p.paid.select("customer_id").distinct().count()
    assert sizes == payers


def test_retention_is_100_in_own_month_and_cumulative_matches(spark):
    from donorlens.plans.catalog import _plan as tplan
    p = tplan(spark, "/root/testdata/sf0.01")
    rr_long = reshape.rr_t(p.rr_cohorts())
    # cohorts that start inside the window have RR 100 in their own month's slot
    as_of = p.as_of
    for r in rr_long.collect():
        own_slot = (as_of.year * 12 + as_of.month) - (r["cohort_month"].year * 12 + r["cohort_month"].month) + 1
        if r["month"] == own_slot:
            assert float(r["rr"]) == 100.0
        assert 0.0 <= float(r["rr"]) <= 100.0
    wide = p.cohorts_revenue_arppu_data()
    cum = p.arppu_cumulative()
    j = wide.join(cum, ["cohort_month", "total_users"]).collect()
    for r in j:
        total = sum(r[f"revenue_month_{k}"] for k in range(1, 13))
        expect = (total / r["total_users"]).quantize(type(total)("0.01"), rounding="ROUND_HALF_UP")
        assert r["cumulative_arppu_1"] == expect


def test_unpivot_then_pivot_is_identity(spark):
    from donorlens.plans.catalog import _plan as tplan
    p = tplan(spark, "/root/testdata/sf0.001")
    wide = p.ltv_cohorts().select("cohort_month", *[f"ltv_month_{k}" for k in range(12, 0, -1)])
    long = reshape.ltv_t(wide)
    back = reshape.widen(long, ["cohort_month"], {"ltv": lambda k: f"ltv_month_{k}"}, list(range(12, 0, -1)),
                         slot_col="month")
    assert back.select(wide.columns).exceptAll(wide).count() == 0
    assert wide.exceptAll(back.select(wide.columns)).count() == 0
    assert long.count() == 12 * wide.count()


def test_slot_wide_is_one_aggregate_over_the_grid(spark):
    from donorlens.plans.catalog import _plan as tplan
    p = tplan(spark, "/root/testdata/sf0.001")
    plan = cohorts.revenue_arppu(p.slots)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 0


def test_empty_orders_give_empty_marts(spark, orders_df):
    orders = orders_df([(1, 1, "Cancelled", "2024-01-05 10:00", 100)])
    p = MartPlan(orders, as_of="2024-03-31")
    for name in ("rfm", "cohorts_paid", "cohorts_revenue_arppu_data", "arppu_cumulative", "rr_cohorts", "ac_cohort",
                 "cdr", "paid_only", "rr_t", "ac_t"):
        assert getattr(p, name)().count() == 0, name
    # the unpaid order still makes an all-user cohort, with zero revenue and LTV
    ltv = p.ltv_cohorts().collect()
    assert len(ltv) == 1 and float(ltv[0]["ltv_month_3"]) == 0.0


def test_as_of_before_all_orders_has_empty_slots(spark, orders_df):
    orders = orders_df([(1, 1, "Paid", "2024-05-05 10:00", 100)])
    p = MartPlan(orders, as_of="2024-01-15")
    r = p.cohorts_revenue_arppu_data().collect()[0]
    assert all(float(r[f"revenue_month_{k}"]) == 0.0 for k in range(1, 13))
    assert all(v is None for k, v in p.ac_cohort().collect()[0].asDict().items() if k.startswith("average_check"))
    assert p.rfm().collect()[0]["recency_days"] < 0      # a future order: negative, truncated toward zero
