"""Interval and period predicates.

All return Column predicates, so they compose into one ``filter`` that
Catalyst splits and pushes into the Parquet scan (``PushedFilters``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def valid_at(start: str | Column, end: str | Column, boundary: Column) -> Column:
    """Row valid at ``boundary``: started strictly before, not ended by then.

    ``start < B AND (end IS NULL OR end > B)`` — both bounds strict, so an
    end exactly on the boundary does not count as valid.
    """
    return (_c(start) < boundary) & (_c(end).isNull() | (_c(end) > boundary))


def as_of(df: DataFrame, start: str, end: str, boundary: Column) -> DataFrame:
    return df.filter(valid_at(start, end, boundary))


def as_of_each(df: DataFrame, start: str, end: str, boundaries: DataFrame, out: str, bin_days: int = 31) -> DataFrame:
    """``df`` once for every boundary that it is valid at, as the column ``out`` of ``boundaries``.

    One pass over ``df`` answers all boundaries: time is cut into bins, a row
    goes to the bins between its start and its end (no earlier than the first
    boundary's and no later than the last one's) and meets the boundaries of a
    bin in an equi-join; the strict bounds decide.
    """
    binned = lambda c: F.floor(F.unix_date(c.cast("date")) / bin_days).cast("int")
    points = boundaries.select(F.col(out)).distinct().filter(F.col(out).isNotNull()).withColumn("_bin", binned(F.col(out)))
    first, last = (points.agg(how("_bin")).scalar() for how in (F.min, F.max))
    low = F.greatest(binned(F.col(start)), first)
    high = F.least(F.coalesce(binned(F.col(end)), last), last)
    spread = df.filter(F.col(start).isNotNull()).select("*", low.alias("_low"), high.alias("_high")).filter("_low <= _high")
    each = spread.withColumn("_bin", F.explode(F.sequence("_low", "_high")))
    return each.join(points, "_bin").filter(valid_at(start, end, F.col(out))).drop("_bin", "_low", "_high")


def currently_active(start: str | Column, end: str | Column) -> Column:
    """Open activation interval: started and not ended."""
    return _c(start).isNotNull() & _c(end).isNull()


def in_period(period_col: str | Column, period: Column) -> Column:
    """Pick one snapshot period (equality on the period column)."""
    return _c(period_col) == period


def between_inclusive(col: str | Column, low: Column, high: Column) -> Column:
    return _c(col).between(low, high)
