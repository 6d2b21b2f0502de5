"""Churn, new-donor ratio and cadence (M-17..M-21)."""

import datetime as dt

from donorlens.operators import base, churn


def _gwc(orders):
    return base.with_cohort(base.donor_month_grid(base.paid_orders(orders)))


def _by_month(df):
    return {r["month"]: r for r in df.collect()}


def test_churn_edge_three_vs_four_months(orders_df):
    orders = orders_df([(1, 1, "Paid", "2024-01-10 10:00", 5), (1, 2, "Paid", "2024-04-10 10:00", 5),
                        (2, 3, "Paid", "2024-01-11 10:00", 5), (2, 4, "Paid", "2024-05-11 10:00", 5)])
    out = _by_month(churn.churn_rate(_gwc(orders)))
    jan = out[dt.date(2024, 1, 1)]
    assert (jan["total_donors"], jan["retained_donors"]) == (2, 1)    # +3 months retained, +4 churned
    assert float(jan["churn_rate"]) == 50.0
    assert float(out[dt.date(2024, 5, 1)]["churn_rate"]) == 100.0     # right-censored month


def test_censored_flag(orders_df):
    orders = orders_df([(1, 1, "Paid", "2024-01-10 10:00", 5), (1, 2, "Paid", "2024-06-10 10:00", 5)])
    out = _by_month(churn.churn_rate(_gwc(orders), censor_flag=True))
    assert out[dt.date(2024, 1, 1)]["censored"] is False
    assert out[dt.date(2024, 6, 1)]["censored"] is True


def test_month_without_new_donors_has_ratio_zero(orders_df):
    orders = orders_df([(1, 1, "Paid", "2024-01-10 10:00", 5), (1, 2, "Paid", "2024-02-10 10:00", 5),
                        (2, 3, "Paid", "2024-01-12 10:00", 5)])
    nd = _by_month(churn.new_donor_ratio(_gwc(orders)))
    assert float(nd[dt.date(2024, 2, 1)]["new_donors_ratio"]) == 0.0
    assert float(nd[dt.date(2024, 1, 1)]["new_donors_ratio"]) == 100.0
    cdr = _by_month(churn.cdr(_gwc(orders)))
    assert float(cdr[dt.date(2024, 2, 1)]["new_donors_ratio"]) == 0.0


def test_span_is_first_to_last_not_per_gap(orders_df):
    orders = orders_df([(1, 1, "Paid", "2024-03-01 10:00", 5), (1, 2, "Paid", "2024-03-05 10:00", 5),
                        (1, 3, "Paid", "2024-03-11 10:00", 5)])
    span = _by_month(churn.donation_span(base.donor_month_grid(base.paid_orders(orders))))
    assert float(span[dt.date(2024, 3, 1)]["avg_days_between_donations"]) == 10.0


def test_cadence_is_next_three_months_and_zero_without_own_repeat(orders_df):
    rows = [
        # Jan: repeat donor (span 2 days); Feb: no repeat donor; Mar: span 4 days; Apr: span 6 days
        (1, 1, "Paid", "2024-01-01 00:00", 5), (1, 2, "Paid", "2024-01-03 00:00", 5),
        (2, 3, "Paid", "2024-02-01 00:00", 5),
        (3, 4, "Paid", "2024-03-01 00:00", 5), (3, 5, "Paid", "2024-03-05 00:00", 5),
        (4, 6, "Paid", "2024-04-01 00:00", 5), (4, 7, "Paid", "2024-04-07 00:00", 5),
    ]
    out = _by_month(churn.cdr(_gwc(orders_df(rows))))
    assert float(out[dt.date(2024, 1, 1)]["avg_days_between_donations"]) == 5.0   # mean(4, 6) of Feb..Apr
    assert float(out[dt.date(2024, 2, 1)]["avg_days_between_donations"]) == 0.0   # no repeat donor in Feb
    assert float(out[dt.date(2024, 3, 1)]["avg_days_between_donations"]) == 6.0
    assert float(out[dt.date(2024, 4, 1)]["avg_days_between_donations"]) == 0.0   # nothing after


def test_churn_in_range_on_driver_data(spark):
    from donorlens.plans.catalog import _plan
    p = _plan(spark, "/root/testdata/sf0.01")
    for r in churn.cdr(p.grid_with_cohort).collect():
        assert 0 <= float(r["churn_rate"]) <= 100
        assert 0 <= float(r["new_donors_ratio"]) <= 100
