"""The business questions, each a function of a lakehouse.

"Now" is the lakehouse's as_of date. Results that are cut to a top-k end their order in a
key, so that the cut is the same every time.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakehouse_kpis.functions.dates import (
    days_before, month_of, month_start, months_before, year_of,
)
from lakehouse_kpis.functions.money import published, ratio
from lakehouse_kpis.operators.gold import bucket_order
from lakehouse_kpis.operators.ranges import within


# --- revenue and margin through the metric view -------------------------------------------

def revenue_by_product_line(lake, months: int = 12, with_margin: bool = False) -> DataFrame:
    measures = ["Net Revenue", "Gross Margin Pct"] if with_margin else ["Net Revenue"]
    result = lake.metrics.query(
        ["Product Line"], measures,
        where=[("Invoice Month", ">=", month_start(lake.as_of, -months))],
        order_by=["-Net Revenue"],
    )
    return _named(result, {"Net Revenue": "net_revenue", "Gross Margin Pct": "gm_pct"})


def best_margin_territory(lake) -> DataFrame:
    """The one territory with the highest margin; the lesser name on a tie."""
    result = lake.metrics.query(
        ["Territory"], ["Gross Margin Pct"], where=["`Territory` IS NOT NULL"],
        order_by=["-Gross Margin Pct", "Territory"], limit=1,
    )
    return _named(result, {"Gross Margin Pct": "gross_margin_pct"})


def best_margin_territories(lake) -> DataFrame:
    """Every territory that shares the highest margin, the unknown territory included."""
    margins = _named(
        lake.metrics.query(["Territory"], ["Gross Margin Pct"]),
        {"Gross Margin Pct": "gross_margin_pct"},
    )
    place = F.rank().over(Window.orderBy(F.desc_nulls_last("gross_margin_pct")))
    return margins.withColumn("place", place).filter("place = 1").drop("place")


def margin_trend(lake) -> DataFrame:
    result = lake.metrics.query(
        ["Invoice Month", "Product Line"], ["Net Revenue", "Gross Margin Pct"],
        order_by=["Invoice Month", "Product Line"],
    )
    return _named(result, {"Net Revenue": "net_revenue", "Gross Margin Pct": "gm_pct"})


def margin_trend_known_lines(lake) -> DataFrame:
    result = lake.metrics.query(
        ["Invoice Month", "Product Line"], ["Gross Margin Pct"],
        where=["`Invoice Month` IS NOT NULL", "`Product Line` IS NOT NULL"],
        order_by=["Invoice Month", "Product Line"],
    )
    return _named(result, {"Invoice Month": "month", "Gross Margin Pct": "gross_margin_pct"})


def discount_by_segment(lake) -> DataFrame:
    result = lake.metrics.query(
        ["Customer Segment"], ["Discount Pct"],
        where=[("Invoice Year", "=", lake.as_of.year)], order_by=["-Discount Pct"],
    )
    return _named(result, {"Discount Pct": "discount_pct"})


def discount_by_known_segment(lake) -> DataFrame:
    result = lake.metrics.query(
        ["Customer Segment"], ["Discount Pct"],
        where=[("Invoice Year", "=", lake.as_of.year), "`Customer Segment` IS NOT NULL"],
        having="`Discount Pct` IS NOT NULL", order_by=["-Discount Pct"],
    )
    return _named(result, {"Discount Pct": "discount_pct"})


def revenue_mix(lake) -> DataFrame:
    result = lake.metrics.query(
        ["Customer Segment", "Territory"], ["Net Revenue"],
        order_by=["Territory", "-Net Revenue"],
    )
    return _named(result, {"Net Revenue": "net_revenue"})


def segment_share(lake) -> DataFrame:
    """Revenue by segment with its share of the territory, the unknown territory included."""
    mix = _named(
        lake.metrics.query(["Customer Segment", "Territory"], ["Net Revenue"]),
        {"Net Revenue": "net_revenue"},
    )
    # summed as exact money again, so that the share does not depend on row order
    whole = F.sum(F.col("net_revenue").cast("decimal(38,2)")).over(Window.partitionBy("Territory"))
    share = ratio(F.col("net_revenue"), whole)
    return mix.withColumn("share_of_territory", share).orderBy(
        "Territory", F.desc("share_of_territory")
    )


def known_segment_share(lake) -> DataFrame:
    """Share by segment against the territory's total over all segments, known ones or not."""
    known = "`Territory` IS NOT NULL"
    parts = lake.metrics.query(
        ["Customer Segment", "Territory"], ["Net Revenue"],
        where=[known, "`Customer Segment` IS NOT NULL"],
    ).withColumnRenamed("Net Revenue", "segment_net_revenue")
    totals = lake.metrics.query(["Territory"], ["Net Revenue"], where=[known])
    totals = totals.withColumnRenamed("Net Revenue", "territory_net_revenue")
    share = ratio(F.col("segment_net_revenue"), F.col("territory_net_revenue"))
    return parts.join(totals, "Territory").withColumn("revenue_share", share).orderBy(
        "Territory", F.desc("revenue_share")
    )


# --- customers and receivables -------------------------------------------------------------

def top_customers(lake, k: int = 10) -> DataFrame:
    best = lake.table("vw_customer_360").orderBy(F.desc("lifetime_revenue_usd"), "customer_key")
    return published(best.limit(k).select(
        "customer_name", "customer_segment", "territory", "lifetime_revenue_usd",
        "lifetime_invoices", "open_pipeline_usd",
    ))


def aging_by_territory(lake, known_only: bool = False) -> DataFrame:
    """Open receivables by territory and age; known_only leaves out the unknown territory."""
    aging = lake.table("ar")
    if known_only:
        aging = aging.filter("territory IS NOT NULL AND aging_bucket IS NOT NULL")
    result = aging.groupBy("territory", "aging_bucket").agg(
        F.sum("outstanding_usd").alias("outstanding_usd"),
        F.sum("invoice_count").alias("invoice_count"),
    )
    return published(result.orderBy("territory", bucket_order(F.col("aging_bucket"))))


def quiet_contractors(lake, pipeline: int = 100_000, days: int = 90) -> DataFrame:
    """Contractors with a large open pipeline and no invoice in the last days.

    The open pipeline and the last invoice are one row per customer before any join.
    """
    last = lake.table("fact_invoice_lines").groupBy("customer_key").agg(
        F.max("invoice_date").alias("last_invoice_date")
    )
    open_deals = (
        lake.table("fact_crm_deals").filter("deal_outcome = 'OPEN'").groupBy("customer_key")
        .agg(F.sum("amount_usd").alias("open_pipeline_usd"))
        .filter(F.col("open_pipeline_usd") > pipeline)
    )
    contractors = (
        lake.table("dim_customer").filter("customer_segment = 'CONTRACTOR'")
        .select("customer_key", "customer_name", "territory")
    )
    seen = F.col("last_invoice_date")
    quiet = seen.isNull() | (seen < F.lit(days_before(lake.as_of, days)))
    result = contractors.join(open_deals, "customer_key").join(last, "customer_key", "left")
    return published(
        result.filter(quiet)
        .select("customer_name", "territory", "open_pipeline_usd", "last_invoice_date")
        .orderBy(F.desc("open_pipeline_usd"))
    )


def visible_customers(lake) -> DataFrame:
    """Customers per territory, as the reader of this lakehouse may count them."""
    return lake.table("dim_customer").groupBy("territory").agg(F.count("*").alias("rows"))


def visible_contacts(lake) -> DataFrame:
    return lake.table("dim_customer").select(
        "customer_key", "email", "phone", "address_line1", "territory"
    )


# --- invoice systems, ledger, web ----------------------------------------------------------

def revenue_by_system(lake, months: int = 24) -> DataFrame:
    start = month_start(lake.as_of, -months)
    recent = within(lake.table("fact_invoice_lines"), "invoice_date", start)
    return published(
        recent.groupBy(month_of("invoice_date").alias("month"), "source_system")
        .agg(F.round(F.sum("net_invoice_amount"), 2).alias("net_revenue"))
        .orderBy("month", "source_system")
    )


def ledger_by_category(
    lake, since: dt.date | None = None, categories: list[str] | None = None
) -> DataFrame:
    """Yearly totals per ledger category, revenue turned positive."""
    gl = within(lake.table("fact_gl_transactions"), "transaction_date", since)
    if categories is not None:
        gl = gl.filter(F.col("gl_category").isin(categories))
    sign = F.when(F.col("gl_category") == "REVENUE", -1).otherwise(1)
    return published(
        gl.groupBy(year_of("transaction_date").alias("year"), "gl_category")
        .agg(F.round(F.sum(F.col("amount_usd") * sign), 2).alias("amount_usd"))
        .orderBy("year", "gl_category")
    )


def ledger_five_years(lake) -> DataFrame:
    return ledger_by_category(lake, months_before(lake.as_of, 60))


def ledger_main_categories(lake) -> DataFrame:
    start = dt.date(lake.as_of.year - 5, 1, 1)
    return ledger_by_category(lake, start, ["REVENUE", "COGS", "OPEX", "CAPEX"])


def quotes_by_campaign(lake) -> DataFrame:
    """Quote requests of the year per campaign; a campaign without any stays, with zero."""
    sessions = _sessions_since_new_year(lake, dt.date(lake.web_as_of.year + 1, 1, 1))
    return sessions.groupBy("campaign").agg(
        F.count_if(_is_quote()).alias("quote_requests")
    ).orderBy(F.desc("quote_requests"))


def campaigns_with_quotes(lake) -> DataFrame:
    """The same, but only campaigns that drew a quote request."""
    quotes = _sessions_since_new_year(lake).filter(_is_quote())
    return quotes.groupBy("campaign").agg(F.count("*").alias("quote_requests")).orderBy(
        F.desc("quote_requests")
    )


def campaign_conversion(lake) -> DataFrame:
    """Share of a campaign's sessions that asked for a quote, in percent."""
    sessions = _sessions_since_new_year(lake)
    percent = F.try_divide(
        (F.col("quotes") * 100).cast("decimal(20,0)"), F.col("sessions").cast("decimal(20,0)")
    )
    return published(
        sessions.groupBy("campaign")
        .agg(F.count("*").alias("sessions"), F.count_if(_is_quote()).alias("quotes"))
        .withColumn("quote_conv_pct", F.round(percent, 2))
        .orderBy(F.desc("quotes"))
    )


def _sessions_since_new_year(lake, before: dt.date | None = None) -> DataFrame:
    start = dt.date(lake.web_as_of.year, 1, 1)
    return within(lake.table("fact_web_engagement"), "session_date", start, before)


def _is_quote() -> Column:
    return F.col("event_name") == "request_quote"


# --- growth of products ---------------------------------------------------------------------

def _yearly_revenue(lake, columns: list[str]) -> DataFrame:
    """Revenue per product and year. The fact is summed per product key first, so that
    the product join moves a row per product and year, however often a product is sold.
    A product key that occurs twice counts twice, as it would when joined line by line."""
    yearly = lake.table("fact_invoice_lines").groupBy(
        "product_key", F.year("invoice_date").alias("yr")
    ).agg(F.sum("net_invoice_amount").alias("revenue"))
    product = lake.table("dim_product").select("product_key", *columns)
    return yearly.join(product, "product_key").groupBy("product_key", *columns, "yr").agg(
        F.sum("revenue").alias("revenue")
    )


def _previous() -> Column:
    """Revenue of the product's previous year with sales, which a gap may separate."""
    return F.lag("revenue").over(Window.partitionBy("product_key").orderBy("yr"))


def product_growth(lake, k: int = 50) -> DataFrame:
    growth = F.col("revenue") - F.col("prev_year_net_rev")
    grown = (
        _yearly_revenue(lake, ["product_name", "product_line"])
        .withColumn("prev_year_net_rev", _previous())
        .withColumn("yoy_growth_usd", growth)
        .filter("yoy_growth_usd IS NOT NULL")
        .orderBy(F.desc("yoy_growth_usd"), "product_key", "yr")
        .limit(k)
    )
    return published(grown.select(
        "product_name", "product_line", "yr", F.col("revenue").alias("net_rev"),
        "prev_year_net_rev", "yoy_growth_usd",
    ))


def product_growth_pct(lake) -> DataFrame:
    """Growth of every product and year in percent; NULL after a year without net revenue."""
    known = _yearly_revenue(lake, ["product_name"]).filter("product_name IS NOT NULL")
    before = F.col("before")
    percent = ratio(F.col("revenue") - before, before) * 100
    return published(
        known.withColumn("before", _previous()).filter("before IS NOT NULL")
        .select(
            F.make_date(F.col("yr"), F.lit(1), F.lit(1)).alias("year"), "product_key",
            "product_name", "revenue", percent.alias("yoy_growth_pct"),
        )
        .orderBy(F.desc_nulls_last("yoy_growth_pct"))
    )


def _named(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


QUESTIONS = {
    "bq01_revenue_by_line": revenue_by_product_line,
    "bq01_revenue_and_margin_by_line": lambda lake: revenue_by_product_line(lake, 12, True),
    "bq02_best_margin_territory": best_margin_territory,
    "bq02_best_margin_territories": best_margin_territories,
    "bq03_top_customers": top_customers,
    "bq04_aging_by_territory": aging_by_territory,
    "bq04_aging_by_known_territory": lambda lake: aging_by_territory(lake, known_only=True),
    "bq05_revenue_by_system": revenue_by_system,
    "bq06_quotes_by_campaign": quotes_by_campaign,
    "bq06_campaigns_with_quotes": campaigns_with_quotes,
    "bq07_margin_trend": margin_trend,
    "bq07_margin_trend_known_lines": margin_trend_known_lines,
    "bq08_quiet_contractors": quiet_contractors,
    "bq09_discount_by_segment": discount_by_segment,
    "bq09_discount_by_known_segment": discount_by_known_segment,
    "bq10_ledger_five_years": ledger_five_years,
    "bq10_ledger_main_categories": ledger_main_categories,
    "bq10_ledger_all_years": ledger_by_category,
    "bq11_product_growth": product_growth,
    "bq11_product_growth_pct": product_growth_pct,
    "bq12_segment_share": segment_share,
    "bq12_known_segment_share": known_segment_share,
    "bq13_campaign_conversion": campaign_conversion,
    "bq14_revenue_mix": revenue_mix,
}
