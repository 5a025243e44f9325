"""Date ranges that reach both the column and the month partitions of a stored fact."""

from __future__ import annotations

import datetime as dt
import functools
import operator
from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def partition_of(date: str) -> str:
    """The partition column that goes with a date column: invoice_date -> invoice_month."""
    return f"{date.removesuffix('_date')}_month"


def between(
    date: str, low: dt.date | None, high: dt.date | None, columns: Collection[str] = (),
    prefix: str = "",
) -> Column:
    """low <= date < high, either end open as None.

    When `columns` has the month partition of the date, the months are bounded too: they
    prune folders, where the date alone could only skip row groups.
    """
    day, month = F.col(prefix + date), F.col(prefix + partition_of(date))
    stored = partition_of(date) in columns
    ends = []
    if low is not None:
        ends.append(day >= F.lit(low))
        if stored:
            ends.append(month >= F.lit(low.replace(day=1)))
    if high is not None:
        ends.append(day < F.lit(high))
        if stored:
            ends.append(month <= F.lit((high - dt.timedelta(days=1)).replace(day=1)))
    return functools.reduce(operator.and_, ends, F.lit(True))


def within(
    df: DataFrame, date: str, low: dt.date | None = None, high: dt.date | None = None
) -> DataFrame:
    return df.filter(between(date, low, high, df.columns))
