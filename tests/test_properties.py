"""Randomised month patterns: churn, new-donor share and cadence against a brute force of the
definitions (plain Python over the same orders)."""

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from donorlens.operators import base, churn

# (customer 1..4, month offset 0..17, day 1..28, hour 0..23)
orders_st = st.lists(st.tuples(st.integers(1, 4), st.integers(0, 17), st.integers(1, 28), st.integers(0, 23)),
                     min_size=1, max_size=40)


def _month(off: int) -> dt.date:
    return dt.date(2023 + off // 12, off % 12 + 1, 1)


def _r2(x: Decimal) -> Decimal:
    return x.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)


def _brute(rows):
    by_cm: dict[tuple[int, int], list[dt.datetime]] = {}
    for c, off, day, hour in rows:
        m = _month(off)
        by_cm.setdefault((c, off), []).append(dt.datetime(m.year, m.month, day, hour))
    months = sorted({off for _, off in by_cm})
    first = {}
    for c, off in by_cm:
        first[c] = min(first.get(c, off), off)
    spans = {}
    for off in months:
        secs = [(max(t) - min(t)).total_seconds() for (c, o), t in by_cm.items() if o == off and len(t) > 1]
        if secs:
            spans[off] = _r2(Decimal(sum(secs)) / (86400 * len(secs)))
    out = {}
    for off in months:
        donors = {c for (c, o) in by_cm if o == off}
        kept = {c for c in donors if any((c, o) in by_cm for o in range(off + 1, off + 4))}
        new = {c for c in donors if first[c] == off}
        churn_rate = _r2(Decimal(100 * (len(donors) - len(kept))) / len(donors))
        ratio = _r2(Decimal(100 * len(new)) / len(donors))
        nxt = [spans[o] for o in range(off + 1, off + 4) if o in spans]
        cadence = _r2(sum(nxt) / len(nxt)) if (off in spans and nxt) else Decimal("0.00")
        out[_month(off)] = (churn_rate, ratio, cadence)
    return out


@settings(max_examples=8, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(orders_st)
def test_cdr_matches_brute_force(spark, orders_df, rows):
    frame = orders_df([(c, i, "Paid", f"{_month(off).isoformat()[:8]}{day:02d} {hour:02d}:00", 10)
                       for i, (c, off, day, hour) in enumerate(rows)])
    got = {r["month"]: (r["churn_rate"], r["new_donors_ratio"], r["avg_days_between_donations"])
           for r in churn.cdr(base.with_cohort(base.donor_month_grid(base.paid_orders(frame)))).collect()}
    assert got == _brute(rows)


def _r(x: Decimal, places: int) -> Decimal:
    return x.quantize(Decimal(1).scaleb(-places), rounding=ROUND_HALF_UP)


# (customer 1..5, month offset 0..17, paid?, amount in cents)
slot_orders_st = st.lists(st.tuples(st.integers(1, 5), st.integers(0, 17), st.booleans(), st.integers(1, 100000)),
                          min_size=1, max_size=40)
AS_OF_OFF = 16  # as-of date 2024-05-20: slot 1 is 2024-05


@settings(max_examples=8, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(slot_orders_st)
def test_slot_marts_match_brute_force(spark, orders_df, rows):
    from donorlens.plans.marts import MartPlan
    frame = orders_df([(c, i, "Paid" if paid else "Cancelled", f"{_month(off).isoformat()[:8]}10 12:00",
                        Decimal(cents) / 100) for i, (c, off, paid, cents) in enumerate(rows)])
    p = MartPlan(frame, as_of="2024-05-20")
    paid = [(c, off, cents) for c, off, ok, cents in rows if ok]
    fpaid, fany = {}, {}
    for c, off, cents in paid:
        fpaid[c] = min(fpaid.get(c, off), off)
    for c, off, _, _ in rows:
        fany[c] = min(fany.get(c, off), off)

    def slot_rev(cohort_off, month_off, first):
        return sum(cents for c, off, cents in paid if first.get(c) == cohort_off and off == month_off)

    ra = {r["cohort_month"]: r for r in p.cohorts_revenue_arppu_data().collect()}
    rr = {r["cohort"]: r for r in p.rr_cohorts().collect()}
    ac = {r["cohort"]: r for r in p.ac_cohort().collect()}
    assert set(ra) == {_month(o) for o in fpaid.values()}
    for co in set(fpaid.values()):
        n = sum(1 for v in fpaid.values() if v == co)
        r, key = ra[_month(co)], _month(co).isoformat()[:7]
        assert r["total_users"] == n
        cum = 0
        for k in range(12, 0, -1):
            m = AS_OF_OFF - (k - 1)
            rev = slot_rev(co, m, fpaid)
            cum += rev
            assert r[f"revenue_month_{k}"] == Decimal(rev) / 100
            assert r[f"arppu_month_{k}"] == _r(Decimal(rev) / (100 * n), 6)
            active = {c for c, off, _ in paid if fpaid[c] == co and off == m}
            assert rr[key][f"RR Month {k}"] == _r(Decimal(100 * len(active)) / n, 2)
            orders = [cents for c, off, cents in paid if fpaid[c] == co and off == m]
            o = k - 1
            name = "average_check_current_month" if o == 0 else f"average_check_month_{o}"
            assert ac[key][name] == (_r(Decimal(sum(orders)) / (100 * len(orders)), 2) if orders else None)
        cumr = {x["cohort_month"]: x for x in p.arppu_cumulative().collect()}[_month(co)]
        assert cumr["cumulative_arppu_1"] == _r(Decimal(cum) / (100 * n), 2)
    ltv = {r["cohort_month"]: r for r in p.ltv_cohorts().collect()}
    assert set(ltv) == {_month(o) for o in fany.values()}
    for co in set(fany.values()):
        n = sum(1 for v in fany.values() if v == co)
        for k in range(1, 13):
            rev = slot_rev(co, AS_OF_OFF - (k - 1), fpaid)   # paid cohort of the same month
            assert ltv[_month(co)][f"ltv_month_{k}"] == _r(Decimal(rev) / (100 * n), 2)
