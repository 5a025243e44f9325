"""The sales metric view: nine dimensions and thirteen measures over the invoice fact."""

from __future__ import annotations

from dataclasses import replace

from lakehouse_kpis.operators.metrics import MetricView

SALES_METRICS = MetricView.from_dict({
    "version": "0.1",
    "source": "fact_invoice_lines",
    "filter": "invoice_date >= DATE '2019-01-01'",
    "joins": [
        {"name": "customer", "source": "dim_customer",
         "on": "source.customer_key = customer.customer_key"},
        {"name": "product", "source": "dim_product",
         "on": "source.product_key = product.product_key"},
    ],
    "dimensions": [
        {"name": "Invoice Month", "expr": "trunc(source.invoice_date, 'MONTH')",
         "truncates": ["invoice_date", "MONTH"]},
        {"name": "Invoice Year", "expr": "year(source.invoice_date)",
         "truncates": ["invoice_date", "YEAR"]},
        {"name": "Invoice Quarter",
         "expr": "concat(year(source.invoice_date), '-Q', quarter(source.invoice_date))"},
        {"name": "Source System", "expr": "source.source_system"},
        {"name": "Territory", "expr": "customer.territory"},
        {"name": "Country", "expr": "customer.country"},
        {"name": "Customer Segment", "expr": "customer.customer_segment"},
        {"name": "Product Line", "expr": "product.product_line"},
        {"name": "Product Tier", "expr": "product.product_tier"},
    ],
    "measures": [
        {"name": "Invoice Count", "expr": "count(DISTINCT source.invoice_id)",
         "approximate": "approx_count_distinct(source.invoice_id)"},
        {"name": "Line Count", "expr": "count(*)"},
        {"name": "Units Sold", "expr": "sum(source.quantity)"},
        {"name": "Gross Revenue", "expr": "sum(source.gross_line_amount)"},
        {"name": "Discounts", "expr": "sum(source.discount_amount)"},
        {"name": "Freight & Pallet", "expr": "sum(source.freight_amount + source.pallet_amount)"},
        {"name": "Net Revenue", "expr": "sum(source.net_invoice_amount)"},
        {"name": "Estimated COGS", "expr": "sum(source.quantity * product.unit_cost_usd)"},
        {"name": "Estimated Gross Margin", "expr": "`Net Revenue` - `Estimated COGS`"},
        # money is exact up to here; a ratio of two totals is a DOUBLE, and 0 where its
        # denominator is 0
        {"name": "Gross Margin Pct",
         "expr": "if(`Net Revenue` = 0, 0D, try_divide(double(`Estimated Gross Margin`), "
                 "double(`Net Revenue`)))"},
        {"name": "Discount Pct",
         "expr": "if(`Gross Revenue` = 0, 0D, try_divide(double(-`Discounts`), "
                 "double(`Gross Revenue`)))"},
        {"name": "Average Invoice Value",
         "expr": "if(`Invoice Count` = 0, 0D, try_divide(double(`Net Revenue`), "
                 "double(`Invoice Count`)))"},
        {"name": "Active Customers", "expr": "count(DISTINCT source.customer_key)",
         "approximate": "approx_count_distinct(source.customer_key)"},
    ],
})


def sales_metrics(start: str | None = "2019-01-01") -> MetricView:
    """The view with its history starting at another day, or with all of it (None)."""
    return replace(
        SALES_METRICS, filter=None if start is None else f"invoice_date >= DATE '{start}'"
    )
