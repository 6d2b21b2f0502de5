"""RFM scoring and segments (M-01..M-04)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from donorlens.functions.numeric import cents_to_money, ratio_decimal, to_cents
from donorlens.functions.timecols import as_of_date, as_of_epoch, epoch_seconds, whole_days_between

# Segment labels and the three-digit codes (recency, frequency, monetary score)
# of each, in the order they are tested. Code 231 is in no list and gets NULL.
SEGMENTS: list[tuple[str, list[str]]] = [
    ("VIP", ["444", "443", "344"]),
    ("Постоянные", ["442", "441", "434", "433", "432", "331", "332", "343", "342", "334"]),
    ("Новые", ["431", "424", "423", "422", "421", "414", "413", "412", "411"]),
    ("Высокий потенциал", ["341", "333", "324", "323", "322", "243"]),
    ("Малоактивные", ["321", "314", "313", "312", "311", "241", "232", "222", "221", "214",
                      "213", "212", "211", "142", "141"]),
    ("Спящие", ["234", "233", "242", "244", "144", "224", "223", "143"]),
    ("Потерянные", ["134", "133", "132", "131", "124", "123", "122", "121", "114", "113",
                    "112", "111"]),
]


def rfm_base(rows: DataFrame, as_of: dt.date | str | None = None, precision: str = "minute") -> DataFrame:
    """M-01: customer_id, recency_days, frequency, monetary_cents per paying customer.

    recency_days is the day field of (as-of midnight - last order): elapsed seconds / 86400
    truncated toward zero, not a calendar-date difference. ``rows``: paid orders (one aggregate by customer, partial per
    task, and no other shuffle), a grid with the customer columns of ``base.with_cohort`` (a filter: one row per
    customer, its first month) or a bare grid (one aggregate by customer).
    """
    as_of = as_of_date(as_of)
    if "cust_last_s" in rows.columns:
        per_customer = rows.where(F.col("month") == F.col("cohort_month")).select(
            "customer_id", F.col("cust_last_s").alias("last_s"), F.col("cust_orders").alias("frequency"),
            F.col("cust_cents").alias("monetary_cents"))
    else:
        if "order_ts" in rows.columns:
            rows = rows.select("customer_id", epoch_seconds("order_ts", precision).alias("last_s"), F.lit(1).alias("n_orders"),
                               to_cents("amount").alias("revenue_cents"))
        per_customer = rows.groupBy("customer_id").agg(
            F.max("last_s").alias("last_s"),
            F.sum("n_orders").alias("frequency"),
            F.sum("revenue_cents").alias("monetary_cents"),
        )
    return per_customer.select(
        "customer_id",
        whole_days_between(F.lit(as_of_epoch(as_of)), F.col("last_s")).cast("int").alias("recency_days"),
        F.col("frequency").cast("int").alias("frequency"),
        "monetary_cents",
    )


def _score(x: str, stats: Column, larger_is_better: bool) -> Column:
    """1..4 by mean +- one sample standard deviation; inclusive bounds; an undefined deviation skips a branch.

    With n values, their sum s and their sum of squares q, all exact, a value lies n*x - s from the mean, in n-ths, and the
    deviation is sqrt(n * (n*q - s*s) / (n - 1)) n-ths: the comparison doesn't depend on how the rows were dealt.
    """
    wide = "decimal(20,0)"
    n, s, q = (stats.getField(k) for k in ("n", f"s_{x}", f"q_{x}"))
    apart = (n.cast(wide) * F.col(x).cast(wide) - s).cast("double")
    spread = F.sqrt(n.cast("double") * (n.cast(wide) * q - s * s).cast("double") / F.nullif(n - 1, F.lit(0)))
    if larger_is_better:
        return F.when(apart >= spread, 4).when(apart >= 0, 3).when(apart >= -spread, 2).otherwise(1)
    return F.when(apart <= -spread, 4).when(apart <= 0, 3).when(apart <= spread, 2).otherwise(1)


def rfm_scores(base: DataFrame) -> DataFrame:
    """M-02: adds recency_score, frequency_score, monetary_score.

    The statistics are one global aggregate of exact decimals (partial per task, one row at the end) used as
    an uncorrelated scalar subquery: no join and no single-partition window over customers.
    """
    values = ("recency_days", "frequency", "monetary_cents")
    wide = lambda x: F.col(x).cast("decimal(19,0)")
    sums = [F.sum(wide(x)).cast("decimal(19,0)").alias(f"s_{x}") for x in values] + [F.sum(wide(x) * wide(x)).cast("decimal(38,0)").alias(f"q_{x}") for x in values]
    stats = base.agg(F.struct(F.count(F.lit(1)).alias("n"), *sums).alias("s")).scalar()
    return base.select("*", *[_score(x, stats, x != "recency_days").alias(f"{x.split('_')[0]}_score") for x in values])


def segment_of(code: Column) -> Column:
    """M-04: segment label of a three-digit code; NULL for a code in no list (231)."""
    expr = None
    for label, codes in SEGMENTS:
        expr = (F.when(code.isin(codes), F.lit(label)) if expr is None
                else expr.when(code.isin(codes), F.lit(label)))
    return expr


def rfm_group_shares(scored: DataFrame) -> DataFrame:
    """M-03: rfm_group, group_count, percent_rfm (share of all customers, rounded to 2).

    At most 4*4*4 = 64 rows, so the total over all groups is a window on <= 64 rows.
    """
    groups = scored.groupBy("rfm_group").agg(F.count(F.lit(1)).alias("group_count"))
    total = F.sum("group_count").over(Window.partitionBy())
    return groups.select("rfm_group", "group_count",
                         ratio_decimal(F.col("group_count"), total, 2, mult=100).alias("percent_rfm"))


def with_group(scored: DataFrame) -> DataFrame:
    return scored.withColumn("rfm_group", F.concat(
        F.col("recency_score").cast("string"), F.col("frequency_score").cast("string"),
        F.col("monetary_score").cast("string")))


def rfm_scored(rows: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    """M-01 + M-02 + group code of a grid or of paid orders. Nothing is written: the statistics, the scores and the
    group shares read the customers alike, so Spark makes the one shuffle by customer once and reuses it."""
    return with_group(rfm_scores(rfm_base(rows, as_of)))


def rfm(rows: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    """Full RFM mart (M-01..M-04), schema ``schemas.RFM``, of a grid or of paid orders.

    The share table is joined back by broadcast: its size is bounded by 64 rows by
    construction (three scores in 1..4), whatever the number of customers.
    """
    grouped = rfm_scored(rows, as_of)
    shares = rfm_group_shares(grouped)
    return grouped.join(F.broadcast(shares), "rfm_group", "left").select(
        "customer_id", "recency_days", "frequency",
        cents_to_money("monetary_cents").alias("monetary"),
        "recency_score", "frequency_score", "monetary_score", "rfm_group", "percent_rfm",
        segment_of(F.col("rfm_group")).alias("cats"),
    )
