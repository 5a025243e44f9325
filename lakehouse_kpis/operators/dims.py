"""Conformed dimensions (silver)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakehouse_kpis.functions.money import money, price
from lakehouse_kpis.functions.text import decode
from lakehouse_kpis.sources import fixed
from lakehouse_kpis.sources.inline import inline

LOADED_AT = "_silver_loaded_at"


def stamped(df: DataFrame) -> DataFrame:
    return df.withColumn(LOADED_AT, F.current_timestamp())


def dim_customer(customers: DataFrame) -> DataFrame:
    return stamped(customers.select(
        F.col("ACCOUNTNUM").alias("customer_key"),
        F.trim("NAME").alias("customer_name"),
        F.lower(F.trim("EMAIL")).alias("email"),
        F.col("PHONE").alias("phone"),
        F.col("ADDRESS_LINE1").alias("address_line1"),
        F.col("CITY").alias("city"),
        F.col("STATE_PROVINCE").alias("state_province"),
        F.col("POSTAL_CODE").alias("postal_code"),
        F.col("COUNTRY").alias("country"),
        F.col("TERRITORY").alias("territory"),
        F.col("CUSTGROUP").alias("customer_segment"),
        _active(F.col("BLOCKED")).alias("is_active"),
        money("CREDITLIMIT_USD").alias("credit_limit_usd"),
        F.col("CREATEDDATETIME").alias("created_at"),
        F.col("MODIFIEDDATETIME").alias("modified_at"),
    ))


def dim_product(products: DataFrame) -> DataFrame:
    return stamped(products.select(
        F.col("ITEMID").alias("product_key"),
        F.col("ITEMNAME").alias("product_name"),
        F.col("ITEMGROUPID").alias("product_line_code"),
        decode(F.col("ITEMGROUPID"), fixed.PRODUCT_LINES, fixed.OTHER_LINE)
        .alias("product_line"),
        F.col("PRODUCTSUBTYPE").alias("product_tier"),
        F.col("SALESUNIT").alias("unit_of_measure"),
        price("UNITCOST_USD").alias("unit_cost_usd"),
        price("LISTPRICE_USD").alias("list_price_usd"),
        _active(F.col("DISCONTINUED")).alias("is_active"),
        F.col("CREATEDDATETIME").alias("created_at"),
    ))


def dim_employee(employees: DataFrame) -> DataFrame:
    return stamped(employees.select(
        F.col("EMPLOYEE_ID").alias("employee_key"),
        F.col("FULL_NAME").alias("full_name"),
        F.col("SSN").alias("ssn"),
        money("ANNUAL_SALARY").alias("annual_salary_usd"),
        F.col("HIRE_DATE").alias("hire_date"),
        F.col("DEPARTMENT_CODE").alias("department_code"),
        F.col("DEPARTMENT").alias("department"),
        F.col("WORK_EMAIL").alias("work_email"),
        F.col("TERRITORY").alias("territory"),
        F.col("STATUS").alias("status"),
    ))


def dim_region(spark: SparkSession) -> DataFrame:
    return inline(
        spark, fixed.REGIONS, ["territory_key", "country_name", "country_code", "timezone"]
    )


def dim_date(
    spark: SparkSession,
    start: dt.date = dt.date(2018, 1, 1),
    end: dt.date = dt.date(2027, 12, 31),
) -> DataFrame:
    """One row per calendar day, both ends included."""
    days = spark.range((end - start).days + 1)
    return calendar(
        days.select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("date_key"))
    )


def dim_date_over(
    dates: Sequence[DataFrame],
    start: dt.date = dt.date(2018, 1, 1),
    end: dt.date = dt.date(2027, 12, 31),
) -> DataFrame:
    """One row per day from start to end and of every year, also those between, that a date of the
    frames (one column each) lies in. Each frame is read once, for its smallest and largest date."""
    ends = reduce(DataFrame.unionByName, [
        df.select(F.min(df.columns[0]).alias("low"), F.max(df.columns[0]).alias("high"))
        for df in dates
    ]).agg(
        F.least(F.min("low"), F.lit(start)).alias("low"),
        F.greatest(F.max("high"), F.lit(end)).alias("high"),
    )
    whole = "sequence(trunc(low, 'YEAR'), date_sub(add_months(trunc(high, 'YEAR'), 12), 1))"
    return calendar(ends.select(F.explode(F.expr(whole)).alias("date_key")))


def calendar(days: DataFrame) -> DataFrame:
    """Calendar attributes of the days in the column date_key."""
    day = F.col("date_key")
    quarter = F.concat(F.year(day).cast("string"), F.lit("-Q"), F.quarter(day).cast("string"))
    return days.select(
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.day(day).alias("day"),
        F.dayofweek(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format(day, "MMM").alias("month_name"),
        quarter.alias("year_quarter"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
    )


def dedupe_latest(
    df: DataFrame, key: str | Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """One row per key: the first one in `order`, which should end in a unique column.

    Spark limits each map task to one row per key before the shuffle (WindowGroupLimit),
    so a key with very many versions does not gather them in one task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def _active(off: Column) -> Column:
    """Active unless the switch is 1; an unset switch counts as active."""
    return F.coalesce(off != 1, F.lit(True))
