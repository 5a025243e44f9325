import datetime as dt

import pytest
from conftest import listed
from pyspark.sql import functions as F

from lakehouse_kpis.plans import questions


class Lake:
    """Just the tables a question asks for."""

    def __init__(self, as_of=dt.date(2024, 6, 30), **tables):
        self.as_of = self.web_as_of = as_of
        self.tables = tables

    def table(self, name):
        return self.tables[name]


@pytest.fixture(scope="module")
def growth(spark):
    sold = [("P1", 2019, 10.0), ("P1", 2019, 5.0), ("P1", 2022, 45.0), ("P2", 2020, 7.0),
            ("P3", 2020, 0.0), ("P3", 2021, 9.0), ("P4", 2020, 1.0), ("P4", 2021, 31.0)]
    fact = spark.createDataFrame(
        [(k, dt.date(y, 5, 1), v) for k, y, v in sold],
        "product_key string, invoice_date date, net_invoice_amount double")
    names = [("P1", "one", "L"), ("P2", "two", "L"), ("P3", "three", "L"), ("P4", "four", "L")]
    product = spark.createDataFrame(
        names, "product_key string, product_name string, product_line string")
    return Lake(fact_invoice_lines=fact, dim_product=product)


def test_growth_spans_a_gap_and_breaks_ties(growth):
    got = [tuple(r) for r in questions.product_growth(growth).collect()]
    assert got == [("one", "L", 2022, 45.0, 15.0, 30.0), ("four", "L", 2021, 31.0, 1.0, 30.0),
                   ("three", "L", 2021, 9.0, 0.0, 9.0)]
    assert len(questions.product_growth(growth, k=1).collect()) == 1


def test_growth_percent_of_zero_is_null(growth):
    got = {r.product_key: r.yoy_growth_pct
           for r in questions.product_growth_pct(growth).collect()}
    assert got == {"P1": 200.0, "P3": None, "P4": 3000.0}


def test_a_product_key_that_occurs_twice_counts_twice(spark, growth):
    twice = growth.tables["dim_product"].filter("product_key = 'P4'")
    lake = Lake(fact_invoice_lines=growth.tables["fact_invoice_lines"],
                dim_product=twice.unionAll(twice))
    assert listed(questions.product_growth(lake), "yr", "net_rev") == [(2021, 62.0)]


def test_quiet_contractors(spark):
    now = dt.date(2024, 6, 30)
    ago = {k: now - dt.timedelta(days=d) for k, d in (("old", 91), ("edge", 90), ("new", 1))}
    customers = spark.createDataFrame(
        [(k, k, "T", "CONTRACTOR") for k in ("old", "edge", "new", "never", "small")]
        + [("home", "home", "T", "HOMEOWNER")],
        "customer_key string, customer_name string, territory string, customer_segment string")
    fact = spark.createDataFrame(
        [(k, d) for k, d in ago.items()] + [("old", dt.date(2020, 1, 1))],
        "customer_key string, invoice_date date")
    deals = spark.createDataFrame(
        [(k, "OPEN", 60_000.0) for k in ("old", "edge", "new", "never", "home")] * 2
        + [("small", "OPEN", 100_000.0), ("small", "WON", 1.0)],
        "customer_key string, deal_outcome string, amount_usd double")
    lake = Lake(now, dim_customer=customers, fact_invoice_lines=fact, fact_crm_deals=deals)
    assert listed(questions.quiet_contractors(lake), "customer_name", "last_invoice_date") == [
        ("never", None), ("old", ago["old"])]


def test_campaigns(spark):
    day, before = dt.date(2024, 2, 1), dt.date(2023, 12, 31)
    web = spark.createDataFrame(
        [("a", "request_quote", day), ("a", "page_view", day), ("a", "page_view", day),
         ("b", "page_view", day), ("c", "request_quote", before)],
        "campaign string, event_name string, session_date date")
    lake = Lake(fact_web_engagement=web)
    assert listed(questions.quotes_by_campaign(lake)) == [("a", 1), ("b", 0)]
    assert listed(questions.campaigns_with_quotes(lake)) == [("a", 1)]
    assert listed(questions.campaign_conversion(lake)) == [("a", 3, 1, 33.33), ("b", 1, 0, 0.0)]


def test_top_customers_breaks_ties_by_key(spark):
    rows = [(k, f"n{k}", 5.0) for k in "dacb"]
    c360 = spark.createDataFrame(
        rows, "customer_key string, customer_name string, lifetime_revenue_usd double"
    ).select("*", F.lit("s").alias("customer_segment"), F.lit("t").alias("territory"),
             F.lit(1).alias("lifetime_invoices"), F.lit(0.0).alias("open_pipeline_usd"))
    got = questions.top_customers(Lake(vw_customer_360=c360), k=3).collect()
    assert [r.customer_name for r in got] == ["na", "nb", "nc"]


def test_shares_sum_to_one(lake):
    got = questions.segment_share(lake).groupBy("Territory").agg(F.sum("share_of_territory"))
    assert all(abs(total - 1) < 1e-9 for _, total in listed(got))


def test_ties_for_the_best_margin(spark):
    class Metrics:
        def query(self, *args, **kw):
            return spark.createDataFrame(
                [("a", 0.5), ("b", 0.5), ("c", 0.1), (None, None)],
                "Territory string, `Gross Margin Pct` double")

    lake = Lake()
    lake.metrics = Metrics()
    assert listed(questions.best_margin_territories(lake)) == [("a", 0.5), ("b", 0.5)]
