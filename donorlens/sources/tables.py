"""Readers and adapters onto the canonical frames.

Canonical ``orders``: customer_id, order_id, status, order_ts, amount (Decimal(18,2)).
Canonical activity stream: user_id, ts.

Adapters only rename, cast and parse; they keep every row and stay lazy, so Catalyst prunes
the unused columns and pushes the status filter into the Parquet scan.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from donorlens.functions.timecols import parse_text_ts
from donorlens.schemas import MONEY_IN

# The status value that marks a paid order in the CSV exports, and the status
# that plays that role in the driver's TPC-H style ``orders`` table.
PAID_STATUS = "Paid"
TPCH_PAID_STATUS = "F"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def orders_from_tpch(orders: DataFrame) -> DataFrame:
    """Driver ``orders`` table -> canonical orders (status ``F`` is the paid status)."""
    return orders.select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias("order_ts"),
        F.col("o_totalprice").cast(MONEY_IN).alias("amount"),
    )


def orders_from_export(orders: DataFrame) -> DataFrame:
    """Reference CSV orders (text timestamps) -> canonical orders.

    ``OrderFirstActionIdsMindboxId`` is the published order id, as in the paid-orders mart. The
    name of a column that didn't parse is carried along as ``bad_value``.
    """
    flag = [F.col("_bad_value").alias("bad_value")] if "_bad_value" in orders.columns else []
    return orders.select(
        F.col("OrderCustomerIdsMindboxId").alias("customer_id"),
        F.col("OrderFirstActionIdsMindboxId").alias("order_id"),
        F.col("OrderLineStatusIdsExternalId").alias("status"),
        parse_text_ts("OrderFirstActionDateTimeUtc").alias("order_ts"),
        F.col("OrderTotalPrice").cast(MONEY_IN).alias("amount"),
        *flag,
    )


def activity_from_export(events: DataFrame) -> DataFrame:
    """Reference CSV events -> activity stream (user_id, ts)."""
    return events.select(
        F.col("CustomerActionCustomerIdsMindboxId").alias("user_id"),
        parse_text_ts("CustomerActionDateTimeUtc").alias("ts"),
    )


def activity_from_orders(orders: DataFrame) -> DataFrame:
    """Canonical orders of any status as the activity stream (user_id, ts)."""
    return orders.select(F.col("customer_id").alias("user_id"), F.col("order_ts").alias("ts"))


def purchases_from_events(events: DataFrame) -> DataFrame:
    """Driver ``events`` purchases as canonical orders: intraday times for recency tests.

    ``event_id`` is the order id, ``value`` the amount; every purchase counts as paid.
    """
    return events.where(F.col("event_type") == "purchase").select(
        F.col("user_id").alias("customer_id"),
        F.col("event_id").alias("order_id"),
        F.lit(TPCH_PAID_STATUS).alias("status"),
        F.col("ts").alias("order_ts"),
        F.col("value").cast(MONEY_IN).alias("amount"),
    )


def tpch_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_from_tpch(read_table(spark, sf_dir, "orders"))
