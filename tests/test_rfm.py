"""RFM semantics (M-01..M-04) on hand-built frames."""

from pyspark.sql import functions as F

from donorlens.operators import base, rfm


def _rfm(orders, as_of):
    grid = base.donor_month_grid(base.paid_orders(orders))
    return {r["customer_id"]: r for r in rfm.rfm(grid, as_of).collect()}


def test_single_customer_stddev_null_scores_333(orders_df):
    out = _rfm(orders_df([(1, 10, "Paid", "2024-01-01 10:00", 100)]), "2024-01-03")
    r = out[1]
    assert (r["recency_score"], r["frequency_score"], r["monetary_score"]) == (3, 3, 3)
    assert r["rfm_group"] == "333"
    assert r["cats"] == "Высокий потенциал"
    assert float(r["percent_rfm"]) == 100.0


def test_recency_is_truncated_elapsed_days_not_date_difference(orders_df):
    out = _rfm(orders_df([(1, 10, "Paid", "2024-01-01 10:00", 5),
                          (2, 11, "Paid", "2024-01-03 09:00", 5)]), "2024-01-03")
    assert out[1]["recency_days"] == 1      # 1 day 14 h, not 2 calendar days
    assert out[2]["recency_days"] == 0      # same day, after midnight: truncated toward zero


def test_only_paid_orders_count(orders_df):
    out = _rfm(orders_df([(1, 10, "Paid", "2024-01-01 10:00", 5),
                          (1, 11, "Cancelled", "2024-01-02 10:00", 7),
                          (2, 12, "Cancelled", "2024-01-02 10:00", 7)]), "2024-01-03")
    assert set(out) == {1}
    assert out[1]["frequency"] == 1 and float(out[1]["monetary"]) == 5.0


def test_code_231_has_no_segment(spark):
    df = spark.createDataFrame([("231",), ("444",), ("111",), ("343",)], "rfm_group string")
    got = dict(df.select("rfm_group", rfm.segment_of(F.col("rfm_group")).alias("s")).collect())
    assert got == {"231": None, "444": "VIP", "111": "Потерянные", "343": "Постоянные"}


def test_segment_map_covers_63_codes_without_overlap():
    codes = [c for _, cs in rfm.SEGMENTS for c in cs]
    assert len(codes) == len(set(codes)) == 63
    all_codes = {f"{r}{f}{m}" for r in range(1, 5) for f in range(1, 5) for m in range(1, 5)}
    assert all_codes - set(codes) == {"231"}


def test_scores_follow_mean_plus_minus_stddev(orders_df):
    # frequencies 1,1,1,5: mean 2, sample sd 2 -> 5 >= 4 scores 4; 1 >= 0 scores 2
    rows = [(c, 100 + c, "Paid", "2024-01-01 10:00", 10) for c in (1, 2, 3)]
    rows += [(4, 200 + i, "Paid", "2024-01-01 10:00", 10) for i in range(5)]
    out = _rfm(orders_df(rows), "2024-01-02")
    assert out[4]["frequency_score"] == 4
    assert out[1]["frequency_score"] == 2


def test_percent_shares_sum_to_100(spark):
    from donorlens.plans.catalog import RAW
    shares = RAW["rfm_group_share"](spark, "/root/testdata/sf0.001").collect()
    total = sum(float(r["percent_rfm"]) for r in shares)
    assert abs(total - 100.0) <= 0.01 * len(shares)
    assert sum(r["group_count"] for r in shares) > 0
