"""Report parameters.

The reference edits session variables by hand before each run (a month
start, a pair of month bounds, a list of PMS names or ids).  Here they are
plain Python values handed to the report functions and folded into the
plan as literals, so Catalyst can push them into the Parquet scans.
"""

from __future__ import annotations

import calendar
import datetime as dt
from dataclasses import dataclass, field


def as_date(value: dt.date | str) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(str(value))


def add_months(d: dt.date, n: int) -> dt.date:
    """Calendar month arithmetic clamped to the month end (as SQL add_months)."""
    y, m = divmod(d.month - 1 + n, 12)
    year, month = d.year + y, m + 1
    return dt.date(year, month, min(d.day, calendar.monthrange(year, month)[1]))


@dataclass(frozen=True)
class ReportMonth:
    """The month being reported, identified by its first day."""

    start: dt.date

    @classmethod
    def of(cls, value: dt.date | str) -> "ReportMonth":
        return cls(as_date(value))

    @property
    def next_start(self) -> dt.date:
        """First day of the following month: the as-of boundary."""
        return add_months(self.start, 1)

    @property
    def last_day(self) -> dt.date:
        return dt.date(self.start.year, self.start.month, self.days)

    @property
    def days(self) -> int:
        """Number of days in the month (the reference's TotalDaysInMonth)."""
        return calendar.monthrange(self.start.year, self.start.month)[1]


@dataclass(frozen=True)
class DateWindow:
    """Inclusive [start, end] bounds given as dates (compared at midnight)."""

    start: dt.date
    end: dt.date

    @classmethod
    def of(cls, start: dt.date | str, end: dt.date | str) -> "DateWindow":
        return cls(as_date(start), as_date(end))


@dataclass(frozen=True)
class PmsSelector:
    """Which practice-management systems a report is about.

    Either by application name or by numeric id, as the scripts do both.
    """

    names: tuple[str, ...] = field(default_factory=tuple)
    ids: tuple[int, ...] = field(default_factory=tuple)

    @classmethod
    def by_name(cls, *names: str) -> "PmsSelector":
        return cls(names=tuple(names))

    @classmethod
    def by_id(cls, *ids: int) -> "PmsSelector":
        return cls(ids=tuple(int(i) for i in ids))

    def __post_init__(self):
        if bool(self.names) == bool(self.ids):
            raise ValueError("select PMS either by names or by ids")
