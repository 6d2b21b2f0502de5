"""The unpivots T-01..T-07 and the generic reshapes.

``to_long`` turns a wide slot mart into (cohort_month, month, value) with one ``stack``
generator: a narrow operator in the same stage as its input, instead of a 12-way UNION ALL
that scans the wide table 12 times. ``widen`` is the inverse (conditional aggregation).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from donorlens.schemas import HORIZON


def widen(long: DataFrame, keys: Sequence[str | Column], values: dict[str, Callable[[int], str]],
          slots: Sequence[int], slot_col: str = "slot") -> DataFrame:
    """Pivot ``long`` to one column per (value, slot), named by ``values[value](slot)``.

    Conditional aggregation with literal slot numbers: one hash aggregate, no distinct-value
    job. ``max`` keeps NULL slots NULL (one row per key and slot).
    """
    aggs = []
    for value, name in values.items():
        for k in slots:
            aggs.append(F.max(F.when(F.col(slot_col) == F.lit(k), F.col(value))).alias(name(k)))
    return long.groupBy(*keys).agg(*aggs)


def to_long(wide: DataFrame, key: str, columns: dict[int, str], value_name: str,
            key_name: str = "cohort_month", slot_name: str = "month") -> DataFrame:
    """Unpivot ``columns`` (slot number -> column) into (key_name, slot_name, value_name).

    ``key`` is a SQL expression over the wide mart (the cohort key, possibly converted).
    """
    args = ", ".join(f"{k}, `{c}`" for k, c in columns.items())
    return wide.selectExpr(f"{key} AS {key_name}", f"stack({len(columns)}, {args}) AS ({slot_name}, {value_name})")


def _by_slot(prefix: str, horizon: int = HORIZON) -> dict[int, str]:
    return {k: f"{prefix}{k}" for k in range(1, horizon + 1)}


# ---- T-01 .. T-07 -------------------------------------------------------------------------

def ltv_t(ltv_cohorts: DataFrame) -> DataFrame:
    """T-01: ltv_month_k -> (cohort_month, month=k, ltv)."""
    return to_long(ltv_cohorts, "cohort_month", _by_slot("ltv_month_"), "ltv")


def revenue_t(ltv_cohorts: DataFrame) -> DataFrame:
    """T-02: revenue of the LTV mart (all-user cohorts, zero-filled) -> (cohort_month, month, revenue)."""
    return to_long(ltv_cohorts, "cohort_month", _by_slot("revenue_month_"), "revenue")


def ltv_cum_t(cumulative_ltv: DataFrame) -> DataFrame:
    """T-03."""
    return to_long(cumulative_ltv, "cohort_month", _by_slot("ltv_cumulative_"), "ltv_cumulative")


def arppu_t(revenue_arppu: DataFrame) -> DataFrame:
    """T-04: unrounded ARPPU."""
    return to_long(revenue_arppu, "cohort_month", _by_slot("arppu_month_"), "arppu")


def arppu_cum_t(arppu_cumulative: DataFrame) -> DataFrame:
    """T-05."""
    return to_long(arppu_cumulative, "cohort_month", _by_slot("cumulative_arppu_"), "cumulative_arppu")


def rr_t(rr_cohorts: DataFrame) -> DataFrame:
    """T-06: text cohort ``YYYY-MM`` back to the first day of the month."""
    return to_long(rr_cohorts, "to_date(cohort, 'yyyy-MM')", _by_slot("RR Month "), "rr")


def ac_t(ac_cohort: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """T-07: offsets 0..horizon-1 (0 = current month)."""
    cols = {0: "average_check_current_month", **{k: f"average_check_month_{k}" for k in range(1, horizon)}}
    return to_long(ac_cohort, "CAST(concat(cohort, '-01') AS DATE)", cols, "average_check")
