import datetime as dt

import pytest
from conftest import first_plan, listed
from pyspark.sql import functions as F

from lakehouse_kpis.operators import gold

NOW = dt.date(2024, 6, 30)


@pytest.mark.parametrize("days, bucket", [
    (-5, "0-30"), (0, "0-30"), (30, "0-30"), (31, "31-60"), (60, "31-60"), (61, "61-90"),
    (90, "61-90"), (91, "91-180"), (180, "91-180"), (181, "181-365"), (365, "181-365"),
    (366, "365+"), (None, "365+"),
])
def test_aging_edges(spark, days, bucket):
    day = None if days is None else NOW - dt.timedelta(days=days)
    fact = spark.createDataFrame(
        [("C1", "I1", day, 5.0), ("C1", "I1", day, 6.0)],
        "customer_key string, invoice_id string, invoice_date date, net_invoice_amount double")
    assert listed(gold.ar_aging(fact, NOW)) == [("C1", bucket, 1, 11.0)]


def test_aging_series_is_single_dates(spark):
    """Invoices over several days and buckets, unknown days, ids and amounts, days ahead."""
    def day(n):
        return NOW - dt.timedelta(days=n)

    rows = [("C1", "I1", day(0), 1.0), ("C1", "I1", day(2), 2.0), ("C1", "I1", day(400), 4.0),
            ("C1", "I2", day(31), 8.0), ("C1", "I2", None, 16.0), ("C1", None, day(61), 32.0),
            ("C2", "I3", day(-40), 64.0), ("C2", "I4", day(95), None), (None, "I5", day(10), 5.0),
            ("C2", "I3", day(-39), 1.0), ("C1", "I1", day(70), 3.0), ("C1", "I1", day(61), 3.0)]
    fact = spark.createDataFrame(
        rows, "customer_key string, invoice_id string, invoice_date date, net_invoice_amount double")
    dates = [day(n) for n in (-60, -41, 0, 1, 29, 30, 30, 90, 500)]
    want = [(d, *row) for d in set(dates) for row in listed(gold.ar_aging(fact, d))]
    series = gold.ar_aging_series(fact, dates)
    assert listed(series) == sorted(want, key=repr)
    assert gold.ar_aging_series(fact.limit(0), dates).count() == 0
    with pytest.raises(ValueError):
        gold.ar_aging_series(fact, [])


def test_aging_series_reads_the_fact_once(spark, lake):
    fact = lake.table("fact_invoice_lines")
    one, many = (gold.ar_aging_series(fact, [NOW - dt.timedelta(days=31 * i) for i in range(n)])
                 for n in (1, 24))
    plans = [first_plan(df) for df in (one, many)]
    assert plans[0].count("FileScan") == plans[1].count("FileScan")
    # the distinct counts add none to those of the fact itself
    assert plans[1].count("Expand") == first_plan(fact).count("Expand")


def test_bucket_order(spark):
    names = ["365+", "0-30", "91-180", "31-60", "181-365", "61-90"]
    df = spark.createDataFrame([(n,) for n in names], "b string")
    got = [r.b for r in df.orderBy(gold.bucket_order(F.col("b"))).collect()]
    assert got == ["0-30", "31-60", "61-90", "91-180", "181-365", "365+"]


def test_finance_signs(spark):
    day = dt.date(2024, 1, 15)
    rows = [("REVENUE", -100.0), ("REVENUE_CONTRA", 5.0), ("COGS", 40.0), ("OPEX", 7.0),
            ("CAPEX", 9.0), ("COGS", 2.0), ("CAPEX", None)]
    gl = spark.createDataFrame(rows, "gl_category string, amount_usd double").select(
        "*", F.lit(day).alias("transaction_date"), F.lit("T").alias("territory"),
        F.lit("B").alias("business_unit"), F.lit("1").alias("gl_account"),
        F.lit("d").alias("gl_description"))
    got = listed(gold.finance_kpis(gl), "gl_category", "revenue_usd", "contra_revenue_usd",
                 "cogs_usd", "opex_usd", "capex_usd", "gl_line_count")
    assert got == [
        ("CAPEX", 0, 0, 0, 0, 9.0, 2), ("COGS", 0, 0, 42.0, 0, 0, 2), ("OPEX", 0, 0, 0, 7.0, 0, 1),
        ("REVENUE", 100.0, 0, 0, 0, 0, 1), ("REVENUE_CONTRA", 0, -5.0, 0, 0, 0, 1)]


def test_customer_360_keeps_customers_without_facts(spark):
    customer = spark.createDataFrame([("C1",), ("C2",)], "customer_key string").select(
        "*", *[F.lit("x").alias(c) for c in
               ("customer_name", "customer_segment", "territory", "country")],
        F.lit(True).alias("is_active"), F.lit(1.0).alias("credit_limit_usd"))
    fact = spark.createDataFrame(
        [("C1", "I1", NOW, 3.0), ("C1", "I1", NOW, 4.0), ("C9", "I2", NOW, 1.0)],
        "customer_key string, invoice_id string, invoice_date date, net_invoice_amount double")
    deals = spark.createDataFrame(
        [("C1", "WON", 10.0), ("C1", "OPEN", 20.0), ("C1", "LOST", 40.0)],
        "customer_key string, deal_outcome string, amount_usd double")
    got = listed(gold.customer_360(customer, fact, deals), "customer_key", "lifetime_invoices",
                 "lifetime_revenue_usd", "last_invoice_date", "lifetime_deals",
                 "won_pipeline_usd", "open_pipeline_usd")
    assert got == [("C1", 1, 7.0, NOW, 3, 10.0, 20.0), ("C2", 0, 0, None, 0, 0, 0)]


def test_duplicate_dimension_keys_fan_out_in_plain_marts(spark):
    fact = spark.createDataFrame(
        [("I1", NOW, "C1", "P1", 2, 10.0, 0.0, 0.0, 0.0, 10.0, "S")],
        "invoice_id string, invoice_date date, customer_key string, product_key string,"
        " quantity int, gross_line_amount double, freight_amount double, discount_amount double,"
        " pallet_amount double, net_invoice_amount double, source_system string")
    customer = spark.createDataFrame(
        [("C1", "T", "S")], "customer_key string, territory string, customer_segment string")
    product = spark.createDataFrame(
        [("P1", "Slabs", "Core", 1.0), ("P1", "Pavers", "Core", 2.0)],
        "product_key string, product_line string, product_tier string, unit_cost_usd double")
    got = listed(gold.sales_summary(fact, customer, product), "product_line", "line_count",
                 "net_revenue_usd", "estimated_cogs_usd", "estimated_gross_margin_usd")
    assert got == [("Pavers", 1, 10.0, 4.0, 6.0), ("Slabs", 1, 10.0, 2.0, 8.0)]


def test_marts_agree_with_the_fact(lake):
    """Bucket totals and customer totals are the fact's totals."""
    whole = lake.table("fact_invoice_lines").agg(F.sum("net_invoice_amount")).first()[0]
    aged = lake.table("vw_ar_aging").agg(F.sum("outstanding_usd")).first()[0]
    per_customer = lake.table("vw_customer_360").agg(F.sum("lifetime_revenue_usd")).first()[0]
    assert whole == aged == per_customer
