"""Date expressions: fiscal years from July, periods, tenure and display texts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

FISCAL_START_MONTH = 7
FIRST_DAY, LAST_DAY = dt.date(1900, 1, 1), dt.date(2100, 1, 1)


def dmy(c: Column, sep: str = "-") -> Column:
    return F.date_format(c, f"dd{sep}MM{sep}yyyy")


def fiscal_year(c: Column) -> Column:
    """The calendar year in which the fiscal year starts."""
    return F.year(F.add_months(c, 1 - FISCAL_START_MONTH))


def fiscal_year_label(c: Column) -> Column:
    year = fiscal_year(c)
    return F.concat(year.cast("string"), F.lit("-"), (year + 1).cast("string"))


def months_left(as_at: Column) -> Column:
    """Whole months from ``as_at`` to the end of its fiscal year."""
    return F.pmod(F.lit(FISCAL_START_MONTH - 1) - F.month(as_at), F.lit(12))


def period_label(c: Column) -> Column:
    return F.date_format(c, "MMM-yy")


def period_name(c: Column) -> Column:
    """Full month and short year, ``March-24``."""
    return F.date_format(c, "MMMM-yy")


def add_months_keep_end(c: Column, n: int) -> Column:
    """Month addition in which a month end stays a month end."""
    moved = F.add_months(c, n)
    return F.when(c == F.last_day(c), F.last_day(moved)).otherwise(moved)


def tenure_end(c: Column) -> Column:
    """Leaving on the 15th or later counts as one month more."""
    return F.when(F.dayofmonth(c) >= 15, add_months_keep_end(c, 1)).otherwise(c)


def tenure_months(start: Column, end: Column) -> Column:
    return F.months_between(tenure_end(end), start).cast("bigint")


def tenure_text(start: Column, end: Column) -> Column:
    months = F.months_between(tenure_end(end), start)
    return F.concat((months / 12).cast("bigint").cast("string"), F.lit(" Years "),
                    F.floor(months % 12).cast("string"), F.lit(" Months "))


def termination_status(c: Column, as_at: Column) -> Column:
    return F.when(c >= as_at, F.lit("Upcoming Terminations")).otherwise("Terminated")


def terminated_flag(c: Column, as_at: Column) -> Column:
    return F.when(c > as_at, F.lit("UT")).when(c.isNotNull(), F.lit("Y"))
