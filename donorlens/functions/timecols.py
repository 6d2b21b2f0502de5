"""Time expressions shared by every mart.

All arithmetic on instants is done on whole epoch seconds (``unix_timestamp``), so the
same code works for ``timestamp`` and ``timestamp_ntz`` columns. The session time zone
must be UTC (see ``donorlens.session``); month grids are calendar months in that zone.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed value: the source text formats are ``DD.MM.YYYY HH24:MI`` and ``DD.MM.YYYY HH24:MI:SS``.
# One lenient Spark pattern reads both (one-digit day/month/hour also accepted).
TEXT_TS_PATTERN = "d.M.yyyy H:mm[:ss]"

SECONDS_PER_DAY = 86400


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_text_ts(c: str | Column) -> Column:
    """Text timestamp -> timestamp; NULL when the text does not parse (quarantined by callers)."""
    return F.try_to_timestamp(col_of(c), F.lit(TEXT_TS_PATTERN))


def format_text_ts(c: str | Column, with_seconds: bool = True) -> Column:
    """Timestamp -> source text format (used to produce CSV fixtures from the driver tables)."""
    return F.date_format(col_of(c), "dd.MM.yyyy HH:mm:ss" if with_seconds else "dd.MM.yyyy HH:mm")


def epoch_seconds(c: str | Column, precision: str = "second") -> Column:
    """Whole epoch seconds of a timestamp, optionally floored to the minute.

    ``precision="minute"`` reproduces reading the text with an ``HH24:MI`` pattern.
    ``pmod`` floors also before 1970.
    """
    s = F.unix_timestamp(col_of(c))
    if precision == "minute":
        return s - F.pmod(s, F.lit(60))
    if precision != "second":
        raise ValueError(f"unknown precision {precision!r}")
    return s


def month_start(c: str | Column) -> Column:
    """First day of the calendar month, as DATE."""
    return F.trunc(col_of(c), "MM")


def month_index(c: str | Column) -> Column:
    """Months since year 0 (year*12 + month-1): consecutive months differ by exactly 1."""
    c = col_of(c)
    return F.year(c) * 12 + F.month(c) - 1


def as_of_date(as_of: dt.date | str | None) -> dt.date:
    if as_of is None:  # the session's date, in its time zone, not that of the driver's host
        return SparkSession.active().sql("SELECT current_date()").first()[0]
    if isinstance(as_of, str):
        return dt.date.fromisoformat(as_of)
    if isinstance(as_of, dt.datetime):
        return as_of.date()
    return as_of


def as_of_epoch(as_of: dt.date) -> int:
    """Epoch seconds of midnight (UTC) of the as-of date: the reference's CURRENT_DATE."""
    return (as_of - dt.date(1970, 1, 1)).days * SECONDS_PER_DAY


def py_month_index(d: dt.date) -> int:
    return d.year * 12 + d.month - 1


def add_months_py(d: dt.date, k: int) -> dt.date:
    """First of month ``k`` months after the month of ``d`` (k may be negative)."""
    idx = py_month_index(d) + k
    return dt.date(idx // 12, idx % 12 + 1, 1)


def slot_months(as_of: dt.date, horizon: int = 12) -> list[dt.date]:
    """Calendar months of the as-of slots, newest first: [current month, current-1, ...]."""
    return [add_months_py(as_of, -k) for k in range(horizon)]


def trunc_div(a: Column, n: int) -> Column:
    """Integer ``a / n`` truncated toward zero, exact: ``a - a % n`` is a multiple of ``n``.

    Spark's ``%`` keeps the dividend's sign (truncating division), so this is the
    PostgreSQL / Java integer division.
    """
    return ((a - a % F.lit(n)) / F.lit(n)).cast("long")


def whole_days_between(later_epoch: Column, earlier_epoch: Column) -> Column:
    """Day field of ``later - earlier``: elapsed seconds / 86400 truncated toward zero."""
    return trunc_div(later_epoch - earlier_epoch, SECONDS_PER_DAY)
