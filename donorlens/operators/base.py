"""Paid orders, the donor x month grid and cohorts (D-09, M-05, M-06, M-07, M-16).

Scale design: raw orders are touched by exactly one aggregation, ``donor_month_grid``, keyed
by (customer, month) with a map-side partial aggregate. A customer holding a third of all
orders therefore costs one combined row per month per map task, never one hot task. Every
later step runs on the grid, where a customer has at most one row per calendar month, so the
per-customer window (``with_cohort``) has a bounded partition size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from donorlens.functions.numeric import to_cents
from donorlens.functions.timecols import epoch_seconds, month_start
from donorlens.sources.tables import PAID_STATUS


def valid_orders(orders: DataFrame) -> DataFrame:
    """Rows that can be attributed: customer and time present, and no value that didn't parse."""
    return orders.where(F.col("customer_id").isNotNull() & F.col("order_ts").isNotNull() & ~_bad_value(orders))


def _bad_value(orders: DataFrame) -> Column:
    return F.col("bad_value").isNotNull() if "bad_value" in orders.columns else F.lit(False)


def rejected_orders(orders: DataFrame) -> DataFrame:
    """Quarantine: rows with a value that didn't parse, no customer or an unparsable/missing time,
    with the reason."""
    reason = (F.when(_bad_value(orders), F.concat(F.lit("bad_value:"), F.col("bad_value")) if "bad_value" in orders.columns
                     else F.lit(None))
              .when(F.col("customer_id").isNull(), F.lit("null_customer"))
              .otherwise(F.lit("bad_timestamp")))
    return (orders.where(F.col("customer_id").isNull() | F.col("order_ts").isNull() | _bad_value(orders))
            .withColumn("reject_reason", reason))


def paid_orders(orders: DataFrame, paid_value: str = PAID_STATUS) -> DataFrame:
    """Canonical paid orders: customer_id, order_id, order_ts, amount (status filter pushed down)."""
    return valid_orders(orders.where(F.col("status") == F.lit(paid_value))).select(
        "customer_id", "order_id", "order_ts", "amount")


def paid_only(orders: DataFrame, paid_value: str = PAID_STATUS) -> DataFrame:
    """D-09 ``paid_only`` mart: user_id, order_id, order_date, order_price (seconds kept)."""
    return valid_orders(orders.where(F.col("status") == F.lit(paid_value))).select(
        F.col("customer_id").alias("user_id"),
        F.col("order_id"),
        F.col("order_ts").alias("order_date"),
        F.col("amount").alias("order_price"),
    )


def donor_month_grid(paid: DataFrame, precision: str = "minute") -> DataFrame:
    """M-16: one row per (customer, calendar month) with paid orders.

    Columns: customer_id, month (DATE), n_orders, revenue_cents, first_s, last_s (epoch
    seconds of the first/last order that month, at ``precision`` - the reference reads these
    times with an ``HH24:MI`` pattern, so minutes by default).
    """
    # each per-row expression evaluated once, in the same codegen stage as the partial aggregate
    rows = paid.select("customer_id", month_start("order_ts").alias("month"),
                       to_cents("amount").alias("cents"), epoch_seconds("order_ts", precision).alias("ts_s"))
    return rows.groupBy("customer_id", "month").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum("cents").alias("revenue_cents"),
        F.min("ts_s").alias("first_s"),
        F.max("ts_s").alias("last_s"),
    )


def combine_grids(parts: DataFrame) -> DataFrame:
    """Combine partial grids (e.g. one per loaded segment) into one row per (customer, month):
    counts and sums add, first/last times combine by min/max. A partial aggregate."""
    return parts.groupBy("customer_id", "month").agg(
        F.sum("n_orders").alias("n_orders"), F.sum("revenue_cents").alias("revenue_cents"),
        F.min("first_s").alias("first_s"), F.max("last_s").alias("last_s"))


def first_actions(activity: DataFrame) -> DataFrame:
    """user_id, first_ts: each user's first action (the state behind the all-user cohorts)."""
    return (activity.where(F.col("user_id").isNotNull() & F.col("ts").isNotNull())
            .groupBy("user_id").agg(F.min("ts").alias("first_ts")))


def combine_first_actions(parts: DataFrame) -> DataFrame:
    return parts.groupBy("user_id").agg(F.min("first_ts").alias("first_ts"))


def with_cohort(grid: DataFrame) -> DataFrame:
    """Grid + per-customer columns, all from one shuffle of the grid by customer:

    cohort_month (first paid month), next_month (next active month or NULL), and the
    customer's totals cust_last_s, cust_orders, cust_cents (for RFM). The running minimum of
    an ascending month is the first month; the totals use the same partitioning, so Spark adds
    no exchange for them. Partitions hold at most one row per calendar month.
    """
    by_customer = Window.partitionBy("customer_id")
    ordered = by_customer.orderBy("month")
    return grid.select(
        "*",
        F.min("month").over(ordered).alias("cohort_month"),
        F.lead("month").over(ordered).alias("next_month"),
        F.max("last_s").over(by_customer).alias("cust_last_s"),
        F.sum("n_orders").over(by_customer).alias("cust_orders"),
        F.sum("revenue_cents").over(by_customer).alias("cust_cents"),
    )


def rejected_activity(activity: DataFrame) -> DataFrame:
    """Quarantine of the activity stream: no user or an unparsable/missing time."""
    reason = F.when(F.col("user_id").isNull(), F.lit("null_user")).otherwise(F.lit("bad_timestamp"))
    return (activity.where(F.col("user_id").isNull() | F.col("ts").isNull())
            .withColumn("reject_reason", reason))


def first_activity_cohorts(activity: DataFrame) -> DataFrame:
    """M-05: user_id, cohort_month = month of the user's first action of any kind."""
    return (activity.where(F.col("user_id").isNotNull() & F.col("ts").isNotNull())
            .groupBy("user_id").agg(F.min("ts").alias("first_ts"))
            .select("user_id", month_start("first_ts").alias("cohort_month")))


def paid_cohorts(grid: DataFrame) -> DataFrame:
    """M-06: user_id, cohort_month = month of the first paid order.

    A filter on a grid that already carries ``cohort_month`` (one row per customer: its first
    month), else one aggregate by customer.
    """
    if "cohort_month" in grid.columns:
        return grid.where(F.col("month") == F.col("cohort_month")).select(
            F.col("customer_id").alias("user_id"), "cohort_month")
    return grid.groupBy(F.col("customer_id").alias("user_id")).agg(F.min("month").alias("cohort_month"))


def cohort_sizes(cohorts: DataFrame) -> DataFrame:
    """M-07: cohort_month, total_users."""
    return cohorts.groupBy("cohort_month").agg(F.count(F.lit(1)).alias("total_users"))


def cohort_matrix(grid_with_cohort: DataFrame) -> DataFrame:
    """Paid cohort x calendar month: active_users, orders, revenue_cents.

    ``active_users`` in the cohort's own month is the cohort size. The result has at most
    months^2 rows whatever the number of orders.
    """
    return grid_with_cohort.groupBy("cohort_month", "month").agg(
        F.count(F.lit(1)).alias("active_users"),
        F.sum("n_orders").alias("orders"),
        F.sum("revenue_cents").alias("revenue_cents"),
    )
