"""Composition of the operators into the 18 published marts (lazy DataFrames).

``MartPlan`` holds the shared intermediates. The only place raw orders are aggregated is
``donor_month_grid``; everything else reads the grid (customer x month) or tables derived from
it whose size is bounded by the number of months. The pipeline materialises the grid once
(see ``plans.pipeline``), so the 18 marts cost one pass over the orders.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame

from donorlens import schemas
from donorlens.functions.timecols import as_of_date
from donorlens.operators import base, churn, cohorts, reshape, rfm
from donorlens.schemas import HORIZON
from donorlens.sources.tables import PAID_STATUS, activity_from_orders


def conform(df: DataFrame, schema) -> DataFrame:
    """D-10: cast and order the columns of a mart to its fixed schema (no-op casts vanish)."""
    return df.selectExpr(*[f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields])


# ---- the plan ------------------------------------------------------------------------------

@dataclass
class MartPlan:
    """All marts for one as-of snapshot.

    ``orders``: canonical orders (any status). ``activity``: the (user_id, ts) stream whose
    first action defines the all-user cohorts for LTV; defaults to all orders of any status.
    ``grid``: an already materialised donor x month grid (optionally with the cohort columns
    of ``base.with_cohort``), if the caller has one; ``slot_table`` / ``user_sizes``: already
    materialised ``slots`` / ``all_user_sizes``; ``paid_sizes``: the paid cohorts' sizes, with which the slots
    read their months of the grid alone.
    """
    orders: DataFrame
    as_of: dt.date | str | None = None
    paid_value: str = PAID_STATUS
    activity: DataFrame | None = None
    grid: DataFrame | None = None
    slot_table: DataFrame | None = None
    user_sizes: DataFrame | None = None
    paid_sizes: DataFrame | None = None
    horizon: int = HORIZON
    precision: str = "minute"

    def __post_init__(self):
        self.as_of = as_of_date(self.as_of)
        if self.activity is None:
            self.activity = activity_from_orders(base.valid_orders(self.orders))

    @cached_property
    def paid(self) -> DataFrame:
        return base.paid_orders(self.orders, self.paid_value)

    @cached_property
    def donor_grid(self) -> DataFrame:
        return self.grid if self.grid is not None else base.donor_month_grid(self.paid, self.precision)

    @cached_property
    def grid_with_cohort(self) -> DataFrame:
        g = self.donor_grid
        return g if "cohort_month" in g.columns else base.with_cohort(g)

    @cached_property
    def matrix(self) -> DataFrame:
        return base.cohort_matrix(self.grid_with_cohort)

    @cached_property
    def all_user_cohorts(self) -> DataFrame:
        return base.first_activity_cohorts(self.activity)

    @cached_property
    def all_user_sizes(self) -> DataFrame:
        if self.user_sizes is not None:
            return self.user_sizes
        return base.cohort_sizes(self.all_user_cohorts)

    @cached_property
    def slots(self) -> DataFrame:
        """Per paid cohort: size and the slot measures (``cohorts.slot_wide``)."""
        if self.slot_table is not None:
            return self.slot_table
        return cohorts.slot_wide(self.grid_with_cohort, self.as_of, self.horizon, self.paid_sizes)

    @cached_property
    def rfm_rows(self) -> DataFrame:
        """What RFM is made of: a grid that is there already, else the paid orders (one aggregate by customer)."""
        return self.grid_with_cohort if self.grid is not None else self.paid

    # published marts
    def rfm(self) -> DataFrame:
        return conform(rfm.rfm(self.rfm_rows, self.as_of), schemas.RFM)

    def cohorts_all(self) -> DataFrame:
        return conform(self.all_user_cohorts, schemas.COHORTS)

    def cohorts_paid(self) -> DataFrame:
        return conform(base.paid_cohorts(self.donor_grid), schemas.COHORTS)

    def cohorts_revenue_arppu_data(self) -> DataFrame:
        return conform(cohorts.revenue_arppu(self.slots, self.horizon), schemas.REVENUE_ARPPU)

    def arppu_cumulative(self) -> DataFrame:
        return conform(cohorts.arppu_cumulative(self.slots, self.horizon), schemas.ARPPU_CUMULATIVE)

    def ltv_cohorts(self) -> DataFrame:
        return conform(cohorts.ltv(self.slots, self.all_user_sizes, self.horizon), schemas.LTV_COHORTS)

    def cumulative_ltv(self) -> DataFrame:
        return conform(cohorts.ltv_cumulative(self.ltv_cohorts(), self.horizon), schemas.CUMULATIVE_LTV)

    def rr_cohorts(self) -> DataFrame:
        return conform(cohorts.retention(self.slots, self.horizon), schemas.RR_COHORTS)

    def ac_cohort(self) -> DataFrame:
        return conform(cohorts.average_check(self.slots, self.horizon), schemas.AC_COHORT)

    def cdr(self) -> DataFrame:
        return conform(churn.cdr(self.grid_with_cohort), schemas.CDR)

    def paid_only(self) -> DataFrame:
        return conform(base.paid_only(self.orders, self.paid_value), schemas.PAID_ONLY)

    # long marts T-01..T-07: one narrow stack over the wide mart
    def ltv_t(self) -> DataFrame:
        return conform(reshape.ltv_t(self.ltv_cohorts()), schemas.LTV_T)

    def revenue_t(self) -> DataFrame:
        return conform(reshape.revenue_t(self.ltv_cohorts()), schemas.REVENUE_T)

    def ltv_cum_t(self) -> DataFrame:
        return conform(reshape.ltv_cum_t(self.cumulative_ltv()), schemas.LTV_CUM_T)

    def arppu_t(self) -> DataFrame:
        return conform(reshape.arppu_t(self.cohorts_revenue_arppu_data()), schemas.ARPPU_T)

    def arppu_cum_t(self) -> DataFrame:
        return conform(reshape.arppu_cum_t(self.arppu_cumulative()), schemas.ARPPU_CUM_T)

    def rr_t(self) -> DataFrame:
        return conform(reshape.rr_t(self.rr_cohorts()), schemas.RR_T)

    def ac_t(self) -> DataFrame:
        return conform(reshape.ac_t(self.ac_cohort(), self.horizon), schemas.AC_T)

    MART_NAMES = ("rfm", "cohorts_all", "cohorts_paid", "cohorts_revenue_arppu_data", "arppu_cumulative",
                  "ltv_cohorts", "cumulative_ltv", "rr_cohorts", "ac_cohort", "cdr", "ltv_t", "revenue_t",
                  "ltv_cum_t", "arppu_t", "arppu_cum_t", "rr_t", "ac_t", "paid_only")

    def marts(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name)() for name in self.MART_NAMES}
