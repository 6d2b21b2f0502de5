"""Exact money and ratio arithmetic.

Money is carried as whole cents in ``long`` columns inside the marts (fast, exact,
order-independent sums) and turned into ``Decimal`` only on output. Every rounded ratio is
computed by integer division on ``Decimal`` operands, so the result is the exact value
rounded half away from zero - the rounding of PostgreSQL ``ROUND(numeric, s)`` - with no
intermediate rounding at a fixed decimal scale.

Each helper returns one Spark SQL expression. Arguments are SQL expression text (a column
name is one) or ``Column`` objects; with text arguments the whole formula is a single
``F.expr`` - one parse instead of dozens of Python-to-JVM calls, which matters for the wide
marts that generate hundreds of these columns.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

INT38 = DecimalType(38, 0)
MONEY = DecimalType(38, 2)


def ratio_scaled_sql(num: str, den: str, scale: int = 2, mult: int = 1) -> str:
    """SQL: ``round(num * mult / den, scale) * 10^scale`` as an integral DECIMAL, half away
    from zero; NULL when ``den`` is 0 or NULL (the reference's ``NULLIF(den, 0)``)."""
    k2 = 2 * mult * 10**scale
    # integral division of decimals is exact for operands of any size; only the quotient has to
    # fit a BIGINT. Overflow raises under ANSI mode.
    d = f"CAST(({den}) AS DECIMAL(20,0))"
    x = f"CAST(CAST(abs({num}) AS DECIMAL(28,0)) * CAST({k2} AS DECIMAL(9,0)) + {d} AS DECIMAL(38,0))"
    q = f"CAST({x} div CAST({d} * CAST(2 AS DECIMAL(1,0)) AS DECIMAL(38,0)) AS DECIMAL(20,0))"
    return f"(CASE WHEN ({den}) != 0 THEN (CASE WHEN ({num}) < 0 THEN -{q} ELSE {q} END) END)"


def scaled_to_decimal_sql(q: str, scale: int) -> str:
    """SQL: integer ``q`` -> DECIMAL(38, scale) holding ``q / 10^scale`` (exact)."""
    if scale == 0:
        return f"CAST({q} AS DECIMAL(38,0))"
    return (f"CAST(CAST({q} AS DECIMAL(25,0)) / CAST({10**scale} AS DECIMAL({scale + 1},0)) "
            f"AS DECIMAL(38,{scale}))")


def ratio_sql(num: str, den: str, scale: int = 2, mult: int = 1) -> str:
    """SQL: ``round(num * mult / den, scale)`` as DECIMAL(38, scale); NULL when den is 0."""
    return scaled_to_decimal_sql(ratio_scaled_sql(num, den, scale, mult), scale)


def cents_to_money_sql(cents: str) -> str:
    return scaled_to_decimal_sql(cents, 2)


# ---- Column API --------------------------------------------------------------------------------

def _c(x: str | Column) -> Column:
    return F.expr(x) if isinstance(x, str) else x


def to_cents(amount: str | Column) -> Column:
    """Decimal(18,2) amount -> whole cents (long). Exact for any 2-decimal amount."""
    return (_c(amount) * F.lit(100)).cast("long")


def scaled_to_decimal(q: str | Column, scale: int) -> Column:
    if isinstance(q, str):
        return F.expr(scaled_to_decimal_sql(q, scale))
    if scale == 0:
        return q.cast(INT38)
    quotient = q.cast(DecimalType(25, 0)) / F.lit(10**scale).cast(DecimalType(scale + 1, 0))
    return quotient.cast(DecimalType(38, scale))


def cents_to_money(cents: str | Column) -> Column:
    """Whole cents -> Decimal(38,2)."""
    return scaled_to_decimal(cents, 2)


def ratio_scaled(num: str | Column, den: str | Column, scale: int = 2, mult: int = 1) -> Column:
    """Column form of ``ratio_scaled_sql`` (``den`` must be >= 0)."""
    if isinstance(num, str) and isinstance(den, str):
        return F.expr(ratio_scaled_sql(num, den, scale, mult))
    num, den = _c(num), _c(den)
    k2 = 2 * mult * 10**scale
    d = den.cast(DecimalType(20, 0))
    x = (F.abs(num).cast(DecimalType(28, 0)) * F.lit(k2).cast(DecimalType(9, 0)) + d).cast(INT38)
    q = F.call_function("div", x, (d * F.lit(2).cast(DecimalType(1, 0))).cast(INT38)).cast(DecimalType(20, 0))
    return F.when(den != 0, F.when(num < 0, -q).otherwise(q))


def ratio_decimal(num: str | Column, den: str | Column, scale: int = 2, mult: int = 1) -> Column:
    """``round(num * mult / den, scale)`` as Decimal(38, scale); NULL when ``den`` is 0."""
    if isinstance(num, str) and isinstance(den, str):
        return F.expr(ratio_sql(num, den, scale, mult))
    return scaled_to_decimal(ratio_scaled(num, den, scale, mult), scale)
