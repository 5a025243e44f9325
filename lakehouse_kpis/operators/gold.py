"""Published marts (gold)."""

from __future__ import annotations

import datetime as dt
from bisect import bisect_right
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakehouse_kpis.functions.dates import month_of
from lakehouse_kpis.functions.money import zero_if_null, zero_unless
from lakehouse_kpis.sources import fixed

CUSTOMER_COLUMNS = [
    "customer_key", "customer_name", "email", "phone", "address_line1", "city",
    "state_province", "postal_code", "country", "territory", "customer_segment", "is_active",
    "credit_limit_usd", "created_at",
]
EMPLOYEE_COLUMNS = [
    "employee_key", "full_name", "ssn", "annual_salary_usd", "hire_date", "department_code",
    "department", "work_email", "territory", "status",
]


def customer_directory(dim_customer: DataFrame) -> DataFrame:
    return dim_customer.select(*CUSTOMER_COLUMNS)


def employee_directory(dim_employee: DataFrame) -> DataFrame:
    return dim_employee.select(*EMPLOYEE_COLUMNS)


def sales_summary(fact: DataFrame, customer: DataFrame, product: DataFrame) -> DataFrame:
    """Monthly sales by territory, segment, line, tier and system.

    Inner joins: a line without customer or product is left out, and a dimension key that
    occurs twice counts its lines twice, as in the plain SQL join.
    """
    keys = [
        "invoice_month", "territory", "customer_segment", "product_line", "product_tier",
        "source_system",
    ]
    lines = (
        fact.join(customer.select("customer_key", "territory", "customer_segment"), "customer_key")
        .join(
            product.select("product_key", "product_line", "product_tier", "unit_cost_usd"),
            "product_key",
        )
        .withColumn("invoice_month", month_of("invoice_date"))
    )
    # a row for the sums and one for the invoice: the sums are put together before they are shuffled,
    # and what is shuffled for each invoice holds no sums
    invoice, own = F.when(F.col("_of") == 1, F.col("invoice_id")), F.col("_of") == 0
    sums = {
        "line_count": F.count(F.when(own, 1)),
        "units_sold": F.sum(F.when(own, F.col("quantity"))),
        "gross_revenue_usd": F.sum(F.when(own, F.col("gross_line_amount"))),
        "discount_usd": F.sum(F.when(own, F.col("discount_amount"))),
        "freight_pallet_usd": F.sum(F.when(own, F.col("freight_amount") + F.col("pallet_amount"))),
        "net_revenue_usd": F.sum(F.when(own, F.col("net_invoice_amount"))),
        "estimated_cogs_usd": F.sum(F.when(own, F.col("quantity") * F.col("unit_cost_usd"))),
    }
    parts = lines.withColumn("_of", F.explode(F.array(F.lit(0), F.lit(1)))).groupBy(
        *keys, "_of", invoice.alias("_invoice")
    ).agg(*[total.alias(name) for name, total in sums.items()])
    # one row of a group holds its sums
    whole = parts.groupBy(*keys).agg(
        F.count("_invoice").alias("invoice_count"),
        *[F.max(F.when(own, F.col(name))).alias(name) for name in sums],
    )
    net, cogs = F.col("net_revenue_usd"), F.col("estimated_cogs_usd")
    return whole.select(
        *keys, "invoice_count", "line_count", "units_sold",
        *[F.round(name, 2).alias(name) for name in [*sums][2:]],
        F.round(net - cogs, 2).alias("estimated_gross_margin_usd"),
    )


def finance_kpis(gl: DataFrame) -> DataFrame:
    """Monthly ledger totals; revenue and contra revenue with their sign turned.

    The category is one of the grouping columns, so one sum per group is enough: it goes to
    the column of its category, and the other columns are zero.
    """
    def column(category: str, sign: int) -> Column:
        return F.round(zero_unless(F.col("gl_category") == category, F.col("amount") * sign), 2)

    grouped = gl.groupBy(
        month_of("transaction_date").alias("gl_month"), "territory", "business_unit",
        "gl_category", "gl_account", "gl_description",
    ).agg(F.sum("amount_usd").alias("amount"), F.count("*").alias("gl_line_count"))
    return grouped.select(
        "gl_month", "territory", "business_unit", "gl_category", "gl_account",
        "gl_description",
        column("REVENUE", -1).alias("revenue_usd"),
        column("REVENUE_CONTRA", -1).alias("contra_revenue_usd"),
        column("COGS", 1).alias("cogs_usd"),
        column("OPEX", 1).alias("opex_usd"),
        column("CAPEX", 1).alias("capex_usd"),
        "gl_line_count",
    )


def customer_360(customer: DataFrame, fact: DataFrame, deals: DataFrame) -> DataFrame:
    """Every customer with lifetime sales and pipeline; both facts are reduced to one row
    per customer before they are joined."""
    sales = fact.groupBy("customer_key").agg(
        F.count_distinct("invoice_id").alias("lifetime_invoices"),
        F.round(F.sum("net_invoice_amount"), 2).alias("lifetime_revenue_usd"),
        F.max("invoice_date").alias("last_invoice_date"),
    )
    pipeline = deals.groupBy("customer_key").agg(
        F.count("*").alias("lifetime_deals"),
        outcome_total("WON").alias("won_pipeline_usd"),
        outcome_total("OPEN").alias("open_pipeline_usd"),
    )
    profile = customer.select(
        "customer_key", "customer_name", "customer_segment", "territory", "country",
        "is_active", "credit_limit_usd",
    )
    return (
        profile.join(sales, "customer_key", "left").join(pipeline, "customer_key", "left")
        .select(
            *profile.columns,
            F.coalesce("lifetime_invoices", F.lit(0)).alias("lifetime_invoices"),
            zero_if_null("lifetime_revenue_usd").alias("lifetime_revenue_usd"),
            "last_invoice_date",
            F.coalesce("lifetime_deals", F.lit(0)).alias("lifetime_deals"),
            zero_if_null("won_pipeline_usd").alias("won_pipeline_usd"),
            zero_if_null("open_pipeline_usd").alias("open_pipeline_usd"),
        )
    )


def outcome_total(outcome: str) -> Column:
    return F.sum(zero_unless(F.col("deal_outcome") == outcome, F.col("amount_usd")))


def aging_bucket(days: Column) -> Column:
    """Bucket of an age in days; a negative age is young, an unknown one is old."""
    bucket = None
    for bound, name in fixed.AGING_BUCKETS:
        bucket = (F if bucket is None else bucket).when(days <= bound, name)
    return bucket.otherwise(fixed.OLDEST_BUCKET)


def bucket_order(bucket: Column) -> Column:
    """Position of a bucket, youngest first."""
    names = [name for _, name in fixed.AGING_BUCKETS] + [fixed.OLDEST_BUCKET]
    return F.array_position(F.array(*[F.lit(n) for n in names]), bucket)


def ar_aging(fact: DataFrame, as_of: dt.date) -> DataFrame:
    age = F.datediff(F.lit(as_of), F.col("invoice_date"))
    return fact.groupBy("customer_key", aging_bucket(age).alias("aging_bucket")).agg(
        F.count_distinct("invoice_id").alias("invoice_count"),
        F.round(F.sum("net_invoice_amount"), 2).alias("outstanding_usd"),
    )


def ar_aging_series(fact: DataFrame, as_ofs: Sequence[dt.date]) -> DataFrame:
    """`ar_aging` at every one of several dates, with as_of as one more column, from one pass.

    The bounds of all buckets of all dates cut time into cells; within a cell an invoice line is in
    the same bucket at each date. So the fact is reduced to customers by cells once, and only that is
    read once per date. An invoice with lines in several cells counts once a bucket: a cell keeps which
    cell of the same invoice comes before, and counts where the two are in different buckets.
    """
    days = sorted(set(as_ofs))
    if not days:
        raise ValueError("no dates")
    bounds = [bound for bound, _ in fixed.AGING_BUCKETS]
    cuts = sorted({day - dt.timedelta(days=b) for day in days for b in bounds})
    # of each date: the cells from which on a line is as young as each bound
    dates = F.array(*[F.struct(F.lit(day).alias("as_of"), F.array(*[
        F.lit(bisect_right(cuts, day - dt.timedelta(days=b))) for b in bounds
    ]).alias("from")) for day in days])
    names = F.array(*[F.lit(n) for _, n in fixed.AGING_BUCKETS], F.lit(fixed.OLDEST_BUCKET))

    def bucket(cell: Column) -> Column:
        return F.size(F.filter(F.col("at.from"), lambda c: c > cell))

    # one shuffle of the lines for the cells and for the order of an invoice's cells
    cells = fact.select(
        "customer_key", "invoice_id", _cell(F.col("invoice_date"), cuts).alias("cell"),
        "net_invoice_amount",
    ).repartition("customer_key", "invoice_id").groupBy("customer_key", "invoice_id", "cell").agg(
        F.sum("net_invoice_amount").alias("amount")
    )
    invoice = Window.partitionBy("customer_key", "invoice_id").orderBy("cell")
    reduced = cells.withColumn("older", F.lag("cell").over(invoice)).groupBy(
        "customer_key", "cell", "older"
    ).agg(F.count("invoice_id").alias("n"), F.sum("amount").alias("amount"))
    # a customer has as many rows as there are pairs of cells at most, so all of them go to one task
    # before they are copied to every date, and the copies are added up where they are made
    aged = reduced.repartition("customer_key").select("*", F.explode(dates).alias("at")).select(
        "at.as_of", "customer_key", "n", "amount", bucket(F.col("cell")).alias("place"),
        F.when(F.col("older").isNotNull(), bucket(F.col("older"))).alias("place_before"),
    )
    again = F.col("place_before") == F.col("place")
    return aged.groupBy("as_of", "customer_key", F.get(names, "place").alias("aging_bucket")).agg(
        F.sum(F.when(again, 0).otherwise(F.col("n"))).alias("invoice_count"),
        F.round(F.sum("amount"), 2).alias("outstanding_usd"),
    )


def _cell(day: Column, cuts: Sequence[dt.date], first: int = 0) -> Column:
    """How many of the cuts a day has reached, found by halving; 0 for an unknown day."""
    if not cuts:
        return F.lit(first)
    middle = len(cuts) // 2
    return F.when(
        day >= F.lit(cuts[middle]), _cell(day, cuts[middle + 1:], first + middle + 1)
    ).otherwise(_cell(day, cuts[:middle], first))
