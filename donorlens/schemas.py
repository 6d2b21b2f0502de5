"""Schemas of the sources, the canonical frames and the published marts."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY_IN = T.DecimalType(18, 2)
MONEY = T.DecimalType(38, 2)
PCT = T.DecimalType(5, 2)
RATIO2 = T.DecimalType(38, 2)
RATIO6 = T.DecimalType(38, 6)


def _s(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# --- sources, as the CSV exports name them (fixed values: column names of the exports) -----
ORDERS_CSV = _s(
    ("OrderIdsMindboxId", T.LongType()),
    ("OrderFirstActionIdsMindboxId", T.LongType()),
    ("OrderCustomerIdsMindboxId", T.LongType()),
    ("OrderFirstActionDateTimeUtc", T.StringType()),
    ("OrderTotalPrice", MONEY_IN),
    ("OrderLineStatusIdsExternalId", T.StringType()),
)
EVENTS_CSV = _s(
    ("CustomerActionIdsMindboxId", T.LongType()),
    ("CustomerActionCustomerIdsMindboxId", T.LongType()),
    ("CustomerActionDateTimeUtc", T.StringType()),
)
ORDERS_KEY = "OrderIdsMindboxId"
EVENTS_KEY = "CustomerActionIdsMindboxId"
ORDERS_CUSTOMER = "OrderCustomerIdsMindboxId"

# --- canonical frames every operator takes -------------------------------------------------
# orders: customer_id, order_id, status, order_ts, amount
# paid:   customer_id, order_id, order_ts, amount          (status filter applied)
# activity (any action stream): user_id, ts
ORDERS = _s(
    ("customer_id", T.LongType()),
    ("order_id", T.LongType()),
    ("status", T.StringType()),
    ("order_ts", T.TimestampType()),
    ("amount", MONEY_IN),
)

# --- published marts -------------------------------------------------------------------------
HORIZON = 12


def _slots(prefix: str, t: T.DataType, horizon: int = HORIZON) -> list[tuple[str, T.DataType]]:
    return [(f"{prefix}{k}", t) for k in range(horizon, 0, -1)]


RFM = _s(
    ("customer_id", T.LongType()),
    ("recency_days", T.IntegerType()),
    ("frequency", T.IntegerType()),
    ("monetary", MONEY),
    ("recency_score", T.IntegerType()),
    ("frequency_score", T.IntegerType()),
    ("monetary_score", T.IntegerType()),
    ("rfm_group", T.StringType()),
    ("percent_rfm", RATIO2),
    ("cats", T.StringType()),
)
COHORTS = _s(("user_id", T.LongType()), ("cohort_month", T.DateType()))
REVENUE_ARPPU = _s(("cohort_month", T.DateType()), ("total_users", T.LongType()),
                   *_slots("revenue_month_", MONEY), *_slots("arppu_month_", RATIO6))
ARPPU_CUMULATIVE = _s(("cohort_month", T.DateType()), ("total_users", T.LongType()),
                      *_slots("cumulative_arppu_", RATIO2))
LTV_COHORTS = _s(("cohort_month", T.DateType()), ("total_users", T.LongType()),
                 *_slots("revenue_month_", MONEY), *_slots("ltv_month_", RATIO2))
CUMULATIVE_LTV = _s(("cohort_month", T.DateType()), ("total_users", T.LongType()),
                    *_slots("ltv_cumulative_", RATIO2))
RR_COHORTS = _s(("cohort", T.StringType()), ("total_users", T.LongType()), *_slots("RR Month ", PCT))
AC_COHORT = _s(("cohort", T.StringType()), ("unique_users", T.LongType()),
               ("average_check_current_month", RATIO2),
               *[(f"average_check_month_{k}", RATIO2) for k in range(1, HORIZON)])
CDR = _s(("month", T.DateType()), ("churn_rate", RATIO2), ("new_donors_ratio", RATIO2),
         ("avg_days_between_donations", RATIO2))
PAID_ONLY = _s(("user_id", T.LongType()), ("order_id", T.LongType()), ("order_date", T.TimestampNTZType()),
               ("order_price", MONEY_IN))


def long_schema(value: str, t: T.DataType) -> T.StructType:
    return _s(("cohort_month", T.DateType()), ("month", T.IntegerType()), (value, t))


LTV_T = long_schema("ltv", RATIO2)
REVENUE_T = long_schema("revenue", MONEY)
LTV_CUM_T = long_schema("ltv_cumulative", RATIO2)
ARPPU_T = long_schema("arppu", RATIO6)
ARPPU_CUM_T = long_schema("cumulative_arppu", RATIO2)
RR_T = long_schema("rr", PCT)
AC_T = long_schema("average_check", RATIO2)
