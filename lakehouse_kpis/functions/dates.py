"""Calendar helpers. Truncations return DATE."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_of(col: Column | str) -> Column:
    return F.trunc(col, "MONTH")


def quarter_of(col: Column | str) -> Column:
    return F.trunc(col, "QUARTER")


def year_of(col: Column | str) -> Column:
    return F.trunc(col, "YEAR")


def month_start(day: dt.date, months: int = 0) -> dt.date:
    """First day of the month `months` away from the month of `day`."""
    index = day.year * 12 + day.month - 1 + months
    return dt.date(index // 12, index % 12 + 1, 1)


def days_before(day: dt.date, days: int) -> dt.date:
    return day - dt.timedelta(days=days)


def months_before(day: dt.date, months: int) -> dt.date:
    """Same day of an earlier month, or its last day if that month is shorter."""
    first = month_start(day, -months)
    last = month_start(first, 1) - dt.timedelta(days=1)
    return first.replace(day=min(day.day, last.day))
