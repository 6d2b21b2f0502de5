"""Exact ratio rounding against Python's Decimal (ROUND_HALF_UP is half away from zero)."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from donorlens.functions.numeric import cents_to_money, ratio_decimal
from donorlens.functions.timecols import trunc_div

pairs = st.lists(st.tuples(st.integers(-10**12, 10**12), st.integers(0, 10**9)), min_size=1, max_size=300)


def _expected(n, d, scale, mult):
    if d == 0:
        return None
    q = Decimal(1).scaleb(-scale)
    return (Decimal(n) * mult / Decimal(d)).quantize(q, rounding=ROUND_HALF_UP)


@settings(max_examples=5, deadline=None, derandomize=True)
@given(pairs)
def test_ratio_matches_decimal_half_up(spark, rows):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, "n long, d long")
    out = df.select("n", "d", ratio_decimal(F.col("n"), F.col("d"), 2).alias("r2"),
                    ratio_decimal(F.col("n"), F.col("d"), 6).alias("r6"),
                    ratio_decimal("n", "d", 2, 100).alias("pct")).collect()
    for r in out:
        assert r["r2"] == _expected(r["n"], r["d"], 2, 1)
        assert r["r6"] == _expected(r["n"], r["d"], 6, 1)
        assert r["pct"] == _expected(r["n"], r["d"], 2, 100)


def test_exact_halves_round_away_from_zero(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(1, 200), (-1, 200), (3, 200), (5, 1000), (1, 3)], "n long, d long")
    got = [r[0] for r in df.select(ratio_decimal(F.col("n"), F.col("d"), 2)).collect()]
    assert got == [Decimal("0.01"), Decimal("-0.01"), Decimal("0.02"), Decimal("0.01"), Decimal("0.33")]


def test_cents_and_truncating_division(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(12345, -90000), (-5, 86399)], "c long, s long")
    r = df.select(cents_to_money("c"), trunc_div(F.col("s"), 86400)).collect()
    assert r[0][0] == Decimal("123.45") and r[1][0] == Decimal("-0.05")
    assert r[0][1] == -1 and r[1][1] == 0          # toward zero, like the day field of an interval


def test_ratio_has_no_divisor_cap(spark):
    # the average span of 10^9 repeat donors: their count times the seconds of a day is the divisor
    row = spark.createDataFrame([(10**18, 10**9)], "span_s long, donors long")
    got = row.select(ratio_decimal(F.col("span_s"), F.col("donors") * F.lit(86400), 2).alias("x")).first().x
    assert str(got) == "11574.07"
