"""The five dashboard pages: their tiles and filter controls."""

from __future__ import annotations

import datetime as dt
import functools
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakehouse_kpis.functions.money import published
from lakehouse_kpis.operators.tiles import (
    Filter, Selection, Tile, aggregate, average, distinct, facet, facets, filtered, quotient, rows,
    rows_where, together, total, total_where,
)
from lakehouse_kpis.session import written

NET, MARGIN = "net_invoice_amount", "estimated_gross_margin_usd"


_DISCOUNT_PCT = {
    "discount_pct": quotient(total("discount_amount", -1), total("gross_line_amount"))
}
_LEADS, _QUOTES = rows_where("is_lead_event"), rows_where("event_name = 'request_quote'")
_REVENUE_GL = total_where("gl_category = 'REVENUE'", "amount_usd_raw", -1)


def _spend(category: str):
    return total_where(f"gl_category = '{category}'", "amount_usd_raw")


@dataclass(frozen=True)
class Page:
    filters: tuple[Filter, ...]
    tiles: dict[str, Tile]
    # selections to show the cross-filters with
    example: Selection


EXECUTIVE = Page(
    filters=(
        Filter("invoice_date", ("invoices",), is_range=True),
        Filter("territory", ("invoices", "ar", "customers_360", "crm")),
        Filter("customer_segment", ("invoices", "ar", "customers_360")),
        Filter("source_system", ("invoices",)),
        Filter("product_line", ("invoices",)),
    ),
    tiles={
        "net_revenue": Tile("invoices", measures={"net_revenue": total(NET)}),
        "gross_margin": Tile("invoices", measures={"gross_margin": total(MARGIN)}),
        "active_customers": Tile("invoices", measures={"customers": distinct("customer_key")}),
        "invoices": Tile("invoices", measures={"invoices": distinct("invoice_id")}),
        "open_pipeline": Tile("crm", measures={
            "open_pipeline": total_where("deal_outcome = 'OPEN'", "amount_usd")}),
        "avg_line_value": Tile("invoices", measures={"avg_line_value": average(NET)}),
        "revenue_by_month_system": Tile(
            "invoices", ("invoice_month", "source_system"), {"net_revenue": total(NET)}),
        "revenue_by_line": Tile("invoices", ("product_line",), {"net_revenue": total(NET)}),
        "revenue_by_territory": Tile("invoices", ("territory",), {"net_revenue": total(NET)}),
        "revenue_by_segment": Tile(
            "invoices", ("customer_segment",), {"net_revenue": total(NET)}),
        "margin_by_line_tier": Tile(
            "invoices", ("product_line", "product_tier"), {"gross_margin": total(MARGIN)}),
    },
    example={
        "invoice_date": (dt.date(1998, 1, 1), dt.date(2000, 12, 31)),
        "territory": ["US-East", "Canada-West"],
        "product_line": ["Pavers", "Slabs", "Other"],
    },
)

SALES = Page(
    filters=(
        Filter("invoice_date", ("invoices",), is_range=True),
        Filter("territory", ("invoices", "customers_360", "crm")),
        Filter("customer_segment", ("invoices", "customers_360")),
        Filter("product_line", ("invoices",)),
        Filter("lead_source", ("crm",)),
    ),
    tiles={
        "invoices": Tile("invoices", measures={"invoices": distinct("invoice_id")}),
        "avg_line_value": Tile("invoices", measures={"avg_line_value": average(NET)}),
        "discount_pct": Tile("invoices", measures=_DISCOUNT_PCT),
        "deals": Tile("crm", measures={"deals": distinct("deal_id")}),
        "win_rate": Tile("crm", measures={"win_rate": quotient(
            rows_where("deal_outcome = 'WON'"), rows_where("deal_outcome IN ('WON', 'LOST')"))}),
        "products_sold": Tile("invoices", measures={"products": distinct("product_key")}),
        "revenue_by_month_territory": Tile(
            "invoices", ("invoice_month", "territory"), {"net_revenue": total(NET)}),
        "deals_by_outcome": Tile("crm", ("deal_outcome",), {"deals": rows()}),
        "top_customers": Tile(
            "invoices", ("customer_name",), {"net_revenue": total(NET)},
            order_by=("-net_revenue", "customer_name"), limit=15),
        "pipeline_by_stage": Tile("crm", ("deal_stage",), {"pipeline": total("amount_usd")}),
        "discount_pct_by_month": Tile("invoices", ("invoice_month",), _DISCOUNT_PCT),
    },
    example={
        "customer_segment": ["CONTRACTOR"],
        "territory": ["US-West"],
        "lead_source": ["Referral", "Web Form"],
    },
)

FINANCE = Page(
    filters=(
        Filter("transaction_date", ("gl",), is_range=True),
        Filter("gl_year", ("gl",)),
        Filter("gl_category", ("gl",)),
        Filter("business_unit", ("gl",)),
        Filter("territory", ("gl", "ar")),
    ),
    tiles={
        "revenue": Tile("gl", measures={"revenue": _REVENUE_GL}),
        "cogs": Tile("gl", measures={"cogs": _spend("COGS")}),
        "opex": Tile("gl", measures={"opex": _spend("OPEX")}),
        "capex": Tile("gl", measures={"capex": _spend("CAPEX")}),
        "ar_outstanding": Tile("ar", measures={"outstanding": total("outstanding_usd")}),
        "gl_rows": Tile("gl", measures={"gl_rows": rows()}),
        "amount_by_month_category": Tile(
            "gl", ("gl_month", "gl_category"), {"amount": total("amount_usd_signed")}),
        "revenue_by_year": Tile(
            "gl", ("gl_year",), {"revenue": _REVENUE_GL}, order_by=("gl_year",)),
        "amount_by_unit_category": Tile(
            "gl", ("business_unit", "gl_category"), {"amount": total("amount_usd_signed")}),
        "ar_by_bucket_territory": Tile(
            "ar", ("aging_bucket", "territory"), {"outstanding": total("outstanding_usd")}),
        "gl_accounts": Tile(
            "gl", ("gl_account", "gl_description", "gl_category"),
            {"net_amount": total("amount_usd_signed")}, order_by=("gl_account",)),
    },
    example={
        "gl_year": [1999, 2000],
        "gl_category": ["REVENUE", "COGS"],
        "territory": ["US-East", "Canada-East"],
    },
)

MARKETING = Page(
    filters=(
        Filter("session_date", ("web",), is_range=True),
        Filter("traffic_source", ("web",)),
        Filter("traffic_medium", ("web",)),
        Filter("campaign", ("web",)),
        Filter("country", ("web",)),
    ),
    tiles={
        "sessions": Tile("web", measures={"sessions": distinct("session_id")}),
        "visitors": Tile("web", measures={"visitors": distinct("user_pseudo_id")}),
        "lead_events": Tile("web", measures={"lead_events": _LEADS}),
        "quote_requests": Tile("web", measures={"quote_requests": _QUOTES}),
        "lead_conversion": Tile("web", measures={"lead_conversion": quotient(_LEADS, rows())}),
        "campaigns": Tile("web", measures={"campaigns": distinct("campaign")}),
        "sessions_by_month_source": Tile(
            "web", ("session_month", "traffic_source"), {"sessions": distinct("session_id")}),
        "events_by_device": Tile("web", ("device_category",), {"events": rows()}),
        "quotes_by_campaign": Tile("web", ("campaign",), {"quote_requests": _QUOTES}),
        "event_funnel": Tile(
            "web", ("event_name",), {"events": rows()}, order_by=("-events", "event_name")),
        "sessions_by_place": Tile(
            "web", ("country", "territory"), {"sessions": distinct("session_id")}),
    },
    example={
        "session_date": (dt.date(2024, 1, 10), None),
        "traffic_source": ["google", "houzz", "email"],
        "country": ["Canada"],
    },
)

CUSTOMER = Page(
    filters=(
        Filter("territory", ("customers_360", "ar")),
        Filter("customer_segment", ("customers_360", "ar")),
        Filter("country", ("customers_360", "ar")),
    ),
    tiles={
        "customers": Tile("customers_360", measures={"customers": rows()}),
        "active_customers": Tile("customers_360", measures={"customers": rows_where("is_active")}),
        "at_risk": Tile("customers_360", measures={"customers": rows_where(
            "days_since_last_invoice > 90 OR last_invoice_date IS NULL")}),
        "open_pipeline": Tile(
            "customers_360", measures={"open_pipeline": total("open_pipeline_usd")}),
        "credit_limit": Tile(
            "customers_360", measures={"credit_limit": total("credit_limit_usd")}),
        "avg_ltv": Tile("customers_360", measures={"avg_ltv": average("lifetime_revenue_usd")}),
        "ltv_by_segment_territory": Tile(
            "customers_360", ("customer_segment", "territory"),
            {"lifetime_revenue": total("lifetime_revenue_usd")}),
        "pipeline_by_segment": Tile(
            "customers_360", ("customer_segment",),
            {"open_pipeline": total("open_pipeline_usd")}),
        "ar_by_bucket_segment": Tile(
            "ar", ("aging_bucket", "customer_segment"),
            {"outstanding": total("outstanding_usd")}),
        "customer_detail": Tile(
            "customers_360",
            ("customer_name", "customer_segment", "territory", "country",
             "lifetime_revenue_usd", "lifetime_invoices", "open_pipeline_usd",
             "credit_limit_usd", "days_since_last_invoice"),
            order_by=("-lifetime_revenue_usd", "customer_name")),
    },
    example={"territory": ["US-East", None], "customer_segment": ["HOMEOWNER", "COMMERCIAL"]},
)

PAGES = {
    "executive": EXECUTIVE, "sales": SALES, "finance": FINANCE, "marketing": MARKETING,
    "customer": CUSTOMER,
}


def tile(lake, page: str, name: str, selection: Selection | None = None) -> DataFrame:
    """A tile of a page under the page's selections."""
    spec = PAGES[page].tiles[name]
    dataset = filtered(
        PAGES[page].filters, spec.dataset, lake.table(spec.dataset), selection or {}
    )
    return published(aggregate(spec, dataset))


def options(lake, page: str, column: str, selection: Selection | None = None) -> DataFrame:
    """The options of a filter control of a page, with the rows the others leave."""
    filters = PAGES[page].filters
    control = next(f for f in filters if f.column == column)
    frames = {name: lake.table(name) for name in control.datasets}
    return facet(control, filters, frames, selection or {})


def page(lake, name: str, selection: Selection | None = None) -> dict[str, DataFrame]:
    """All tiles of a page under its selections, by name, from one pass over each dataset.

    The groups of a dataset's tiles are written to the shared folder, as every tile reads them; a
    dataset with a tile that lists its rows is written itself, and all its tiles read that.
    """
    spec, found = PAGES[name], {}
    for dataset in sorted({t.dataset for t in spec.tiles.values()}):
        tiles = {n: t for n, t in spec.tiles.items() if t.dataset == dataset}
        frame = filtered(spec.filters, dataset, lake.table(dataset), selection or {})
        lists = {n: t for n, t in tiles.items() if not t.measures}
        if lists:
            frame = written(frame, f"page-{name}-{dataset}")
        found |= {n: published(aggregate(t, frame)) for n, t in lists.items()}
        measured = {n: t for n, t in tiles.items() if t.measures}
        groups, take = together(measured, frame)
        groups = written(groups, f"page-{name}-{dataset}")
        found |= {n: published(take(groups, n)) for n in measured}
    return {n: found[n] for n in spec.tiles}


def page_values(lake, name: str, selection: Selection | None = None) -> DataFrame:
    """A page's measured tiles in one frame: tile, place (its dimensions), measure, value."""
    parts = []
    for n, frame in page(lake, name, selection).items():
        spec = PAGES[name].tiles[n]
        dims = [F.coalesce(F.col(d).cast("string"), F.lit("null")) for d in spec.dims]
        for measure in spec.measures:
            parts.append(frame.select(
                F.lit(n).alias("tile"), F.concat_ws("|", *dims).alias("place"),
                F.lit(measure).alias("measure"), F.col(measure).cast("double").alias("value"),
            ))
    return functools.reduce(DataFrame.unionByName, parts)


def page_options(lake, name: str, selection: Selection | None = None) -> DataFrame:
    """The options of all filter controls of a page, from one pass over each dataset that they reach."""
    filters = PAGES[name].filters
    parts = [
        facets(filters, d, lake.table(d), selection or {}).select(
            "control", F.lit(d).alias("dataset"), "option", "associativity"
        ) for d in sorted({d for f in filters for d in f.datasets})
    ]
    return functools.reduce(DataFrame.unionByName, parts)
