"""Cohort x as-of slot marts (M-08..M-15).

Slots are calendar months anchored to the as-of date, not months since acquisition. This
module numbers them by *offset* o = 0..horizon-1 (month = as-of month - o). Revenue, ARPPU,
LTV and retention publish slot k = o + 1 (``*_12`` is the oldest month, ``*_1`` the as-of
month); the average check publishes the offsets themselves (``current_month``, ``month_1``..).

All slot marts come from one table, ``slot_wide``: a single conditional aggregate per paid
cohort straight over the donor x month grid (map-side partial aggregation leaves one row per
cohort per task, so the shuffle is tiny whatever the volume). Cumulative columns are sums of
columns, not windows, and the long forms are a narrow ``stack`` of the wide marts
(``reshape``) - no join or shuffle after the aggregate except LTV's join of two
months-sized tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from donorlens.functions.numeric import cents_to_money, cents_to_money_sql, ratio_sql
from donorlens.functions.timecols import add_months_py, as_of_date
from donorlens.schemas import HORIZON, PCT

# Decimal places of the unrounded ARPPU (the reference keeps the NUMERIC quotient).
ARPPU_SCALE = 6


def cohort_month_revenue(matrix: DataFrame) -> DataFrame:
    """M-08: cohort_month, month, revenue for every calendar month with paid orders."""
    return matrix.select("cohort_month", "month", cents_to_money("revenue_cents").alias("revenue"))


def slot_wide(grid_with_cohort: DataFrame, as_of: dt.date | str | None = None,
              horizon: int = HORIZON, sizes: DataFrame | None = None) -> DataFrame:
    """cohort_month, total_users, and per offset o: active_o, orders_o, rev_o.

    total_users = customers whose first paid month is the cohort month (each is active then).
    active_o = distinct customers with a paid order in slot month o (the grid has one row per
    customer and month, so a count is a distinct count); orders_o, rev_o = orders and cents.
    Slot sums are NULL when the cohort had no order in that month. The slot months are date
    literals, so the 3 * horizon conditional aggregates stay inside one codegen'd hash aggregate.

    With ``sizes`` (cohort_month, total_users; a row per month) only the slots' months are read: the filter on the month reaches
    the scan, and a stored grid is sorted by month within its files, so other row groups are skipped.
    """
    as_of = as_of_date(as_of)
    aggs = ["count(CASE WHEN month = cohort_month THEN 1 END) AS total_users"] if sizes is None else []
    for o in range(horizon):
        m = f"month = DATE'{add_months_py(as_of, -o).isoformat()}'"
        aggs += [f"count(CASE WHEN {m} THEN 1 END) AS active_{o}",
                 f"sum(CASE WHEN {m} THEN n_orders END) AS orders_{o}",
                 f"sum(CASE WHEN {m} THEN revenue_cents END) AS rev_{o}"]
    if sizes is None:
        return grid_with_cohort.groupBy("cohort_month").agg(*[F.expr(a) for a in aggs])
    window = F.col("month").between(F.lit(add_months_py(as_of, 1 - horizon)), F.lit(add_months_py(as_of, 0)))
    slots = grid_with_cohort.where(window).groupBy("cohort_month").agg(*[F.expr(a) for a in aggs])
    out = sizes.join(slots, "cohort_month", "left")
    return out.select(*[F.coalesce(c, F.lit(0)).alias(c) if c.startswith("active_") else F.col(c) for c in out.columns])


def _rev(o: int) -> str:
    return f"coalesce(rev_{o}, 0L)"


# COALESCE(NULLIF(total_users, 0), 1), in cents per currency unit
_ARPPU_DEN = "coalesce(nullif(total_users, 0), 1) * 100"


def _desc(horizon: int) -> list[int]:
    return list(range(horizon, 0, -1))


def revenue_arppu(sw: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """M-09/M-10: revenue_month_k (0 when empty) and unrounded arppu_month_k = revenue / size."""
    ks = _desc(horizon)
    return sw.selectExpr("cohort_month", "total_users",
                         *[f"{cents_to_money_sql(_rev(k - 1))} AS revenue_month_{k}" for k in ks],
                         *[f"{ratio_sql(_rev(k - 1), _ARPPU_DEN, ARPPU_SCALE)} AS arppu_month_{k}" for k in ks])


def arppu_cumulative(sw: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """M-11: cumulative_arppu_k = round(sum of slot revenue from slot ``horizon`` down to k
    / cohort size, 2) - the sum of the unrounded ARPPUs, rounded once."""
    cols = []
    for k in _desc(horizon):
        total = " + ".join(_rev(j - 1) for j in range(horizon, k - 1, -1))
        cols.append(f"{ratio_sql(total, _ARPPU_DEN, 2)} AS cumulative_arppu_{k}")
    return sw.selectExpr("cohort_month", "total_users", *cols)


def ltv(sw: DataFrame, all_user_sizes: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """M-12: rows are the all-user (first action) cohorts with their size; revenue_month_k is
    the slot revenue of the paid cohort of the same calendar month (0 when none);
    ltv_month_k = round(revenue / all-user cohort size, 2).

    Paid cohorts without an all-user cohort of the same month drop out, as in the reference.
    Both sides of the join have one row per cohort month.
    """
    ks = _desc(horizon)
    paid = sw.select("cohort_month", *[f"rev_{k - 1}" for k in ks])
    j = all_user_sizes.join(paid, "cohort_month", "left")
    return j.selectExpr("cohort_month", "total_users",
                        *[f"{cents_to_money_sql(_rev(k - 1))} AS revenue_month_{k}" for k in ks],
                        *[f"{ratio_sql(_rev(k - 1), 'total_users * 100', 2)} AS ltv_month_{k}" for k in ks])


def ltv_cumulative(ltv_wide: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """M-13: ltv_cumulative_k = sum of the already rounded ltv_month_j, j = horizon..k."""
    cols = []
    for k in _desc(horizon):
        total = " + ".join(f"ltv_month_{j}" for j in range(horizon, k - 1, -1))
        cols.append(f"CAST({total} AS DECIMAL(38,2)) AS ltv_cumulative_{k}")
    return ltv_wide.selectExpr("cohort_month", "total_users", *cols)


def retention(sw: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """M-14: cohort (``YYYY-MM``), total_users, ``RR Month k`` = round(100 * active / size, 2)."""
    pct = f"DECIMAL({PCT.precision},{PCT.scale})"
    return sw.selectExpr("date_format(cohort_month, 'yyyy-MM') AS cohort", "total_users",
                         *[f"CAST({ratio_sql(f'active_{k - 1}', 'total_users', 2, 100)} AS {pct}) AS `RR Month {k}`"
                           for k in _desc(horizon)])


def average_check(sw: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """M-15: cohort, unique_users, average check = round(revenue / orders, 2) per offset;
    NULL when the cohort had no order that month."""
    def name(o: int) -> str:
        return "average_check_current_month" if o == 0 else f"average_check_month_{o}"
    return sw.selectExpr("date_format(cohort_month, 'yyyy-MM') AS cohort", "total_users AS unique_users",
                         *[f"{ratio_sql(f'rev_{o}', f'orders_{o} * 100', 2)} AS {name(o)}" for o in range(horizon)])
