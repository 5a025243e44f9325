"""Exact money.

Sums of DOUBLE depend on task order, so money is held as DECIMAL inside the library
and turned into DOUBLE only where a result leaves it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType

MONEY = DecimalType(18, 2)
# Prices and costs of one unit keep what lies below a cent; any amount fits as a price.
PRICE = DecimalType(22, 6)


def money(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast(MONEY)


def price(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast(PRICE)


def zero_if_null(col: Column | str) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return F.coalesce(col, F.lit(0).cast(MONEY))


def zero_unless(condition: Column, value: Column) -> Column:
    """The value where the condition holds, elsewhere zero; a NULL value stays NULL."""
    return F.when(condition, value).otherwise(F.lit(0).cast(MONEY))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Ratio of two exact totals as DOUBLE; NULL when the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def mean(col: Column | str) -> Column:
    """Average taken from the exact sum."""
    return ratio(F.sum(col), F.count(col))


def published(df: DataFrame) -> DataFrame:
    """The frame with every DECIMAL column as DOUBLE, the type results are published in."""
    exact = [f.name for f in df.schema.fields if isinstance(f.dataType, DecimalType)]
    if not exact:
        return df
    return df.withColumns({name: F.col(f"`{name}`").cast(DoubleType()) for name in exact})
