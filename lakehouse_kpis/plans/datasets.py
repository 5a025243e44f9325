"""Wide datasets behind the dashboards."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakehouse_kpis.functions.dates import month_of, quarter_of


def invoices(fact: DataFrame, customer: DataFrame, product: DataFrame) -> DataFrame:
    """Invoice lines with their customer and product, cost and margin; inner joins."""
    cogs = F.col("quantity") * F.col("unit_cost_usd")
    who = customer.select(
        "customer_key", "customer_name", "customer_segment", "territory", "country",
        "is_active", "credit_limit_usd",
    )
    what = product.select("product_key", "product_line", "product_tier", "unit_cost_usd")
    return fact.join(who, "customer_key").join(what, "product_key").select(
        "invoice_id", "line_num", "invoice_date",
        month_of("invoice_date").alias("invoice_month"),
        quarter_of("invoice_date").alias("invoice_quarter"),
        F.year("invoice_date").alias("invoice_year"),
        "customer_key", "product_key", "quantity", "unit_sales_price", "gross_line_amount",
        "discount_amount", "freight_amount", "pallet_amount", "net_invoice_amount",
        "tax_amount", "source_system", "customer_name", "customer_segment", "territory",
        "country", "is_active", "credit_limit_usd", "product_line", "product_tier",
        "unit_cost_usd",
        F.round(cogs, 2).alias("estimated_cogs_usd"),
        F.round(F.col("net_invoice_amount") - cogs, 2).alias("estimated_gross_margin_usd"),
    )


def ledger(gl: DataFrame) -> DataFrame:
    """Ledger rows with revenue turned positive; contra revenue keeps its sign here."""
    amount = F.col("amount_usd")
    return gl.select(
        "voucher_id", "transaction_date",
        month_of("transaction_date").alias("gl_month"),
        quarter_of("transaction_date").alias("gl_quarter"),
        F.year("transaction_date").alias("gl_year"),
        "gl_account", "gl_description", "gl_category", "business_unit", "territory",
        F.when(F.col("gl_category") == "REVENUE", -amount).otherwise(amount)
        .alias("amount_usd_signed"),
        amount.alias("amount_usd_raw"),
    )


def web(sessions: DataFrame) -> DataFrame:
    return sessions.select(
        "session_id", "user_pseudo_id", "session_date",
        month_of("session_date").alias("session_month"),
        "traffic_source", "traffic_medium", "campaign", "device_category", "country",
        "territory", "product_key", "event_name", "is_lead_event",
    )


def crm(deals: DataFrame) -> DataFrame:
    return deals.select(
        "deal_id", "deal_name", "amount_usd", "deal_stage", "deal_outcome", "customer_key",
        "created_at", month_of("created_at").alias("deal_month"), "territory", "lead_source",
    )


def customers_360(profile: DataFrame, as_of: dt.date) -> DataFrame:
    return profile.withColumn(
        "days_since_last_invoice", F.datediff(F.lit(as_of), F.col("last_invoice_date"))
    )


def ar(aging: DataFrame, customer: DataFrame) -> DataFrame:
    who = customer.select("customer_key", "territory", "customer_segment", "country")
    return aging.join(who, "customer_key").select(
        "customer_key", "aging_bucket", "invoice_count", "outstanding_usd", "territory",
        "customer_segment", "country",
    )


DATASETS = {
    "invoices": lambda lake: invoices(
        lake.table("fact_invoice_lines"), lake.table("dim_customer"), lake.table("dim_product")
    ),
    "gl": lambda lake: ledger(lake.table("fact_gl_transactions")),
    "web": lambda lake: web(lake.table("fact_web_engagement")),
    "crm": lambda lake: crm(lake.table("fact_crm_deals")),
    "customers_360": lambda lake: customers_360(lake.table("vw_customer_360"), lake.as_of),
    "ar": lambda lake: ar(lake.table("vw_ar_aging"), lake.table("dim_customer")),
}
