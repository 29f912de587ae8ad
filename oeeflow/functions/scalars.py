"""Scalar Column helpers (H1-H7). All built-in expressions: they stay in codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = ["col_", "clip", "clip_lower", "safe_div", "null_if_zero", "month_label", "week_label",
           "day_of_month", "days_in_month", "next_month_start", "month_label_short", "weekday0",
           "iso_week", "ratio_or_null", "round6"]


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clip(c: str | Column, lo: float | None = 0.0, hi: float | None = 1.0) -> Column:
    """Clip to [lo, hi]; NULL stays NULL (``greatest``/``least`` alone would skip it)."""
    x = col_(c)
    y = x
    if lo is not None:
        y = F.greatest(y, F.lit(lo))
    if hi is not None:
        y = F.least(y, F.lit(hi))
    return F.when(x.isNull(), F.lit(None).cast("double")).otherwise(y)


def clip_lower(c: str | Column, lo: float = 0.0) -> Column:
    return clip(c, lo, None)


def null_if_zero(c: str | Column) -> Column:
    return F.nullif(col_(c), F.lit(0))


def safe_div(num: str | Column, den: str | Column) -> Column:
    """num / den with a zero divisor giving NULL (ANSI mode raises on x/0)."""
    return col_(num) / F.nullif(col_(den), F.lit(0))


def ratio_or_null(num: str | Column, den: str | Column) -> Column:
    """num / den where den > 0, else NULL."""
    d = col_(den)
    return F.when(d > 0, col_(num) / d)


def weekday0(ts: str | Column) -> Column:
    """0 = Monday ... 6 = Sunday."""
    return F.weekday(col_(ts))


def iso_week(ts: str | Column) -> Column:
    return F.weekofyear(col_(ts))


def month_label(ts: str | Column) -> Column:
    """``yyyy-MM`` period label."""
    return F.date_format(col_(ts), "yyyy-MM")


def month_label_short(month: str | Column) -> Column:
    """``yyyy-MM`` → ``MM-yy``."""
    m = col_(month)
    return F.concat(F.substring(m, 6, 2), F.lit("-"), F.substring(m, 3, 2))


def week_label(ts: str | Column) -> Column:
    """Weekly period ``Mon/Sun`` as ``yyyy-MM-dd/yyyy-MM-dd``."""
    start = F.to_date(F.date_trunc("week", col_(ts)))
    return F.concat(F.date_format(start, "yyyy-MM-dd"), F.lit("/"),
                    F.date_format(F.date_add(start, 6), "yyyy-MM-dd"))


def day_of_month(ts: str | Column) -> Column:
    return F.dayofmonth(col_(ts))


def days_in_month(ts: str | Column) -> Column:
    return F.dayofmonth(F.last_day(col_(ts)))


def next_month_start(d: str | Column) -> Column:
    return F.add_months(F.trunc(F.to_date(col_(d)), "MM"), 1)


def round6(c: str | Column) -> Column:
    return F.round(col_(c), 6)
