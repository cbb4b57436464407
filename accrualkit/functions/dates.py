"""Date helpers for month-based reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from accrualkit.params import as_date


def date_lit(value: dt.date | str) -> Column:
    """A typed DATE literal (never compare dates against raw text)."""
    return F.lit(as_date(value))


def at_midnight(value: dt.date | str) -> Column:
    """A DATE bound promoted to a TIMESTAMP_NTZ at 00:00.

    Comparing a timestamp with a text date bound in the reference's SQL
    promotes the bound to midnight; an upper bound therefore excludes the
    rest of that day.  This keeps that meaning explicit and typed.
    """
    # Built from text: a Python datetime literal would be read in the
    # driver's time zone and shifted by the session time zone on the cast.
    return F.lit(f"{as_date(value).isoformat()} 00:00:00").cast("timestamp_ntz")


def next_month(c: Column) -> Column:
    return F.add_months(c, 1)


def last_day(c: Column) -> Column:
    return F.last_day(c)


def days_in_month(c: Column) -> Column:
    return F.dayofmonth(F.last_day(c))
