"""Monthly churn, new-donor share and donation cadence (M-17..M-21).

All inputs are the donor x month grid; outputs are month-grain tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from donorlens.functions.numeric import ratio_decimal
from donorlens.functions.timecols import SECONDS_PER_DAY, month_index

LOOKAHEAD_MONTHS = 3


def donor_month_stats(grid_with_cohort: DataFrame, lookahead: int = LOOKAHEAD_MONTHS) -> DataFrame:
    """All month-level measures in one aggregate over the grid:
    month, total_donors, retained_donors, new_donors, repeat_donors, span_s.

    ``next_month`` (the donor's next active month, from the per-donor window) replaces the
    equi+range self-join: retained <=> next_month <= m + lookahead months. New donor <=> the
    month is the donor's first paid month. Repeat donor <=> two or more paid orders that
    month; span_s sums their first-to-last seconds.
    """
    g = grid_with_cohort
    retained = F.when(F.col("next_month") <= F.add_months(F.col("month"), lookahead), 1).otherwise(0)
    new = F.when(F.col("month") == F.col("cohort_month"), 1).otherwise(0)
    repeat = F.col("n_orders") > 1
    return g.groupBy("month").agg(
        F.count(F.lit(1)).alias("total_donors"),
        F.sum(retained).alias("retained_donors"),
        F.sum(new).alias("new_donors"),
        F.sum(F.when(repeat, 1).otherwise(0)).alias("repeat_donors"),
        F.sum(F.when(repeat, F.col("last_s") - F.col("first_s"))).alias("span_s"))


def _churn() -> Column:
    return ratio_decimal(F.col("total_donors") - F.col("retained_donors"), F.col("total_donors"), 2, mult=100)


def _new_ratio() -> Column:
    return ratio_decimal(F.col("new_donors"), F.col("total_donors"), 2, mult=100)


def _span_days() -> Column:
    """Average first-to-last span of the repeat donors, days, 2 places; NULL without any."""
    return ratio_decimal(F.col("span_s"), F.col("repeat_donors") * F.lit(SECONDS_PER_DAY), 2)


def churn_rate(grid_with_cohort: DataFrame, lookahead: int = LOOKAHEAD_MONTHS,
               censor_flag: bool = False) -> DataFrame:
    """M-17: of the donors active in month m, the share with no paid month in (m, m+lookahead].

    Columns: month, total_donors, retained_donors, churn_rate (+ ``censored`` when asked: the
    look-ahead window reaches past the last month in the data, so churn is overstated).
    """
    st = donor_month_stats(grid_with_cohort, lookahead)
    out = st.select("month", "total_donors", "retained_donors", _churn().alias("churn_rate"))
    if censor_flag:
        last = F.max("month").over(Window.partitionBy())  # month-grain table
        out = out.withColumn("censored", F.add_months(F.col("month"), lookahead) > last)
    return out


def new_donor_ratio(grid_with_cohort: DataFrame) -> DataFrame:
    """M-18: month, new_donors, total_donors, new_donors_ratio = 100 * new / total (2 places)."""
    st = donor_month_stats(grid_with_cohort)
    return st.select("month", "new_donors", "total_donors", _new_ratio().alias("new_donors_ratio"))


def donation_span(grid: DataFrame) -> DataFrame:
    """M-19: month, repeat_donors, avg_days_between_donations, for months with a repeat donor.

    For donors with two or more paid orders in a month: the first-to-last span in days
    (seconds / 86400), averaged over those donors and rounded to 2.
    """
    rep = grid.where(F.col("n_orders") > 1)
    out = rep.groupBy("month").agg(F.count(F.lit(1)).alias("repeat_donors"),
                                   F.sum(F.col("last_s") - F.col("first_s")).alias("span_s"))
    return out.select("month", "repeat_donors", _span_days().alias("avg_days_between_donations"))


def _next_months_avg(value: Column, lookahead: int) -> Column:
    """round(avg of ``value`` over the months in (m, m+lookahead], 2); NULL when none.

    A range frame on the month index over a month-grain table (one row per calendar month, so
    the single window partition is bounded by the number of months, not by the data volume).
    Replaces the theta self-join, which Spark would plan as a nested-loop join.
    """
    w = Window.orderBy(month_index("month")).rangeBetween(1, lookahead)
    v100 = (value * F.lit(100)).cast("long")
    return ratio_decimal(F.sum(v100).over(w), F.count(v100).over(w) * F.lit(100), 2)


def donation_span_next(span: DataFrame, lookahead: int = LOOKAHEAD_MONTHS) -> DataFrame:
    """M-20: for each month of ``span`` (months with a repeat donor), the mean of the rounded
    values of the months in (m, m+lookahead], rounded to 2; NULL when none has a value."""
    return span.select("month", _next_months_avg(F.col("avg_days_between_donations"), lookahead)
                       .alias("avg_days_between_donations"))


def cdr(grid_with_cohort: DataFrame, lookahead: int = LOOKAHEAD_MONTHS) -> DataFrame:
    """M-21: month, churn_rate, new_donors_ratio, avg_days_between_donations (0 when missing).

    Rows: every month with a paid order. The cadence column of month m is the M-20 value,
    i.e. it describes the following months, and is 0 for a month with no repeat donor of its
    own (the reference's self-join starts from those months). One aggregate, one window.
    """
    st = donor_month_stats(grid_with_cohort, lookahead)
    zero = F.lit(0).cast("decimal(38,2)")
    nxt = F.when(F.col("repeat_donors") > 0, _next_months_avg(_span_days(), lookahead))
    return st.select("month", _churn().alias("churn_rate"),
                     F.coalesce(_new_ratio(), zero).alias("new_donors_ratio"),
                     F.coalesce(nxt, zero).alias("avg_days_between_donations"))
