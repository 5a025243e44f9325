
from __future__ import annotations

import datetime as dt
import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakehouse_kpis.functions.dates import month_of, month_start
from lakehouse_kpis.functions.money import published
from lakehouse_kpis.catalog import Catalog
from lakehouse_kpis.governance import persona
from lakehouse_kpis.governance.policy import (
    GROUP_POLICY, PERSONA_POLICY, Identity, persona_matrix, secure, user_privileges,
)
from lakehouse_kpis.governance.views import Governance
from lakehouse_kpis.operators import dims, facts, gold
from lakehouse_kpis.operators.increment import MONTH, InvoiceFact
from lakehouse_kpis.operators.matview import MaterializedView, in_months
from lakehouse_kpis.operators.rollups import Rollups, rollup
from lakehouse_kpis.plans import dashboards, questions
from lakehouse_kpis.plans.lakehouse import Lakehouse
from lakehouse_kpis.plans.sales_metrics import sales_metrics
from lakehouse_kpis.session import shared_dir, tune, written
from lakehouse_kpis.sources.fixed import PERSONAS
from lakehouse_kpis.sources.retail import RetailTables, legacy_product_key
from oracle.sql import ORACLE

try:  # the training-data subpackage and its pipeline may be left out
    import corpus_pipeline
    from lakehouse_kpis.llm import queries as llm
except ModuleNotFoundError as absent:
    if not (absent.name or "").startswith(("corpus_pipeline", "lakehouse_kpis.llm")):
        raise
    corpus_pipeline = llm = None

AS_OF = dt.date(2001, 8, 31)
WEB_AS_OF = dt.date(2024, 1, 31)
HISTORY = "1995-01-01"  # where the metric view's history starts

Query = Callable[[SparkSession, str], DataFrame]

DIMENSIONS = {
    "month": "Invoice Month", "year": "Invoice Year", "quarter": "Invoice Quarter",
    "system": "Source System", "territory": "Territory", "country": "Country",
    "segment": "Customer Segment", "line": "Product Line", "tier": "Product Tier",
}
# each measure at a grain of its own
MEASURES = {
    "invoice_count": ("Invoice Count", ["Invoice Month", "Territory"]),
    "line_count": ("Line Count", ["Product Tier"]),
    "units_sold": ("Units Sold", ["Invoice Year", "Product Line"]),
    "gross_revenue": ("Gross Revenue", ["Invoice Quarter"]),
    "discounts": ("Discounts", ["Customer Segment", "Source System"]),
    "freight_pallet": ("Freight & Pallet", ["Country"]),
    "net_revenue": ("Net Revenue", ["Territory", "Product Line"]),
    "cogs": ("Estimated COGS", ["Invoice Month"]),
    "gross_margin": ("Estimated Gross Margin", ["Product Line", "Product Tier"]),
    "gross_margin_pct": ("Gross Margin Pct", ["Invoice Quarter", "Territory"]),
    "discount_pct": ("Discount Pct", ["Invoice Month", "Customer Segment"]),
    "average_invoice": ("Average Invoice Value", ["Source System", "Invoice Year"]),
    "active_customers": ("Active Customers", ["Territory", "Invoice Year"]),
}
MASKED = {
    "email": ("dim_customer", "customer_key", "email"),
    "phone": ("dim_customer", "customer_key", "phone"),
    "address": ("dim_customer", "customer_key", "address_line1"),
    "ssn": ("dim_employee", "employee_key", "ssn"),
    "salary": ("dim_employee", "employee_key", "annual_salary_usd"),
}


@functools.lru_cache(maxsize=8)
def lakehouse(spark: SparkSession, sf_dir: str) -> Lakehouse:
    return Lakehouse(
        tune(spark), RetailTables(spark, sf_dir), AS_OF, WEB_AS_OF,
        legacy_product=legacy_product_key(), metric_view=sales_metrics(HISTORY),
    )


def entry(spark: SparkSession) -> DataFrame:
    """Monthly sales by territory, segment, product line, tier and system."""
    return queries()["gold_sales_summary"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    found: dict[str, Callable[[Lakehouse], DataFrame]] = {
        **_bronze(), **_silver(), **_gold(), **_metrics(), **questions.QUESTIONS,
        **_governance(), **_dashboards(), **_written(),
    }
    return {name: _query(plan) for name, plan in found.items()} | _training_data()


def _training_data() -> dict[str, Query]:
    return {} if llm is None else {**llm.QUERIES, "pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE) | ({} if llm is None else llm.ORACLE)


def _query(plan: Callable[[Lakehouse], DataFrame]) -> Query:
    return lambda spark, sf_dir: published(plan(lakehouse(spark, sf_dir)))


def _bronze() -> dict:
    names = [
        "products", "customers", "invoice_lines", "markups", "legacy_headers", "gl",
        "employees", "deals", "sessions",
    ]
    found = {f"bronze_{n}": lambda lake, n=n: lake.bronze(n) for n in names}
    found["bronze_dimension_values"] = _channels
    return found


def _channels(lake: Lakehouse) -> DataFrame:
    """The business-unit and channel master with the ledger rows of each unit."""
    ledger = lake.table("fact_gl_transactions").groupBy("business_unit").agg(
        F.count("*").alias("gl_rows")
    )
    master = lake.bronze("dimension_values")
    return master.join(ledger, master["BU_CODE"] == ledger["business_unit"], "left").drop(
        "business_unit"
    )


def _silver() -> dict:
    stored = [
        "dim_customer", "dim_product", "dim_employee", "fact_invoice_lines",
        "fact_gl_transactions", "fact_web_engagement", "fact_crm_deals",
    ]
    found = {f"silver_{n}": lambda lake, n=n: lake.table(n).drop(dims.LOADED_AT) for n in stored}
    return found | {
        "silver_dim_region": _customers_per_region,
        "silver_dim_date": _revenue_per_day_kind,
        "silver_markup_pivot": lambda lake: facts.markup_pivot(lake.bronze("markups")),
        "silver_header_as_line": lambda lake: facts.header_as_line(
            lake.bronze("legacy_headers"), legacy_product_key()
        ),
        "silver_fact_by_increment": _fact_by_increment,
        "silver_equal_allocation": _equal_allocation,
        "silver_allocation_check": _allocation_check,
        "silver_dedupe_latest": lambda lake: dims.dedupe_latest(
            lake.table("fact_crm_deals").drop(dims.LOADED_AT), "customer_key",
            [F.desc("created_at"), F.desc("deal_id")],
        ),
    }


def _customers_per_region(lake: Lakehouse) -> DataFrame:
    found = lake.table("dim_customer").groupBy("territory").agg(F.count("*").alias("customers"))
    region = lake.table("dim_region")
    return region.join(found, region["territory_key"] == found["territory"], "left").drop(
        "territory"
    )


def _revenue_per_day_kind(lake: Lakehouse) -> DataFrame:
    """Calendar attributes joined to the invoice fact, summed per day before the join."""
    daily = lake.table("fact_invoice_lines").groupBy("invoice_date").agg(
        F.sum("net_invoice_amount").alias("net_revenue"), F.count("*").alias("line_count")
    )
    ends = daily.agg(F.min("invoice_date").alias("low"), F.max("invoice_date").alias("high"))
    calendar = dims.calendar(ends.select(F.explode(F.expr("sequence(low, high)")).alias("date_key")))
    kinds = ["year_quarter", "month", "month_name", "day_of_week", "day_name", "is_weekend"]
    return (
        daily.join(calendar, daily["invoice_date"] == calendar["date_key"], "left").groupBy(*kinds)
        .agg(F.sum("net_revenue").alias("net_revenue"), F.sum("line_count").alias("line_count"))
    )


def _fact_by_increment(lake: Lakehouse) -> DataFrame:
    """The invoice lines after two refreshes: before the second one, the last months have landed and
    the pallet charges of an earlier month."""
    # the join that makes the landed lines runs once; the refreshes read what has landed. A line's
    # system id and the stamps that no refresh asks for are not kept
    landed = written(lake.bronze("invoice_lines").drop(
        "DATAAREAID", "POSTEDDATETIME", "_SYSROWID"), "landed-lines")
    markups = lake.bronze("markups")
    late = (F.col("MARKUPCODE") == "PALLET") & (month_of("TRANSDATE") == month_start(AS_OF, -20))
    held = {
        "invoice_lines": landed.where(F.col("INVOICEDATE") < F.lit(month_start(AS_OF, -3))),
        "markups": markups.where(~late),
    }
    fact = InvoiceFact(
        lake.spark, f"{shared_dir(lake.spark)}/fact_by_increment-{uuid.uuid4().hex}",
        lambda name: held.get(name) if name in held else lake.bronze(name),
        product_key=legacy_product_key(),
    )
    fact.refresh()
    held = {"invoice_lines": landed}
    fact.refresh()
    return fact.read().drop(MONTH, dims.LOADED_AT)


def _divided_charges(lake: Lakehouse) -> DataFrame:
    return facts.fact_invoice_lines(
        lake.bronze("invoice_lines"), lake.bronze("markups"), lake.bronze("legacy_headers"),
        "equal", legacy_product_key(),
    )


def _allocation_check(lake: Lakehouse) -> DataFrame:
    """What the shares of each invoice add up to."""
    return _divided_charges(lake).groupBy("invoice_id").agg(
        *[F.sum(c).alias(c) for c in facts.CHARGES], F.count("*").alias("line_count")
    )


def _equal_allocation(lake: Lakehouse) -> DataFrame:
    fact = _divided_charges(lake)
    amounts = [*facts.CHARGES, "net_invoice_amount"]
    return fact.groupBy(month_of("invoice_date").alias("invoice_month"), "source_system").agg(
        *[F.sum(c).alias(c) for c in amounts]
    )


def _gold() -> dict:
    return {
        "gold_dim_customer": lambda lake: _as(lake, "HR").table("vw_dim_customer"),
        "gold_dim_employee": lambda lake: _as(lake, "FINANCE").table("vw_dim_employee"),
        "gold_sales_summary": lambda lake: lake.table("mv_sales_summary"),
        "gold_finance_kpis": lambda lake: lake.table("vw_finance_kpis"),
        "gold_customer_360": lambda lake: lake.table("vw_customer_360"),
        "gold_ar_aging": lambda lake: lake.table("vw_ar_aging"),
        "gold_ar_aging_series": lambda lake: gold.ar_aging_series(
            lake.table("fact_invoice_lines"),
            [month_start(AS_OF, 1 - i) - dt.timedelta(days=1) for i in range(24)],
        ),
    }


def _metrics() -> dict:
    found = {
        f"metric_{key}": lambda lake, m=measure, d=grain: lake.metrics.query(d, [m])
        for key, (measure, grain) in MEASURES.items()
    }
    found |= {
        f"metric_by_{key}": lambda lake, d=dim: lake.metrics.query(
            [d], ["Net Revenue", "Line Count", "Invoice Count"]
        )
        for key, dim in DIMENSIONS.items()
    }
    every = [measure for measure, _ in MEASURES.values()]
    found |= {
        "metric_total": lambda lake: lake.metrics.query([], every),
        "metric_all_by_territory_line": lambda lake: lake.metrics.query(
            ["Territory", "Product Line"], every
        ),
        "metric_unfiltered_total": lambda lake: sales_metrics(None).bind(
            {n: lake.table(n) for n in ("fact_invoice_lines", "dim_customer", "dim_product")}
        ).query([], ["Line Count", "Net Revenue"]),
        "metric_floor": lambda lake: sales_metrics("1997-01-01").bind(
            {n: lake.table(n) for n in ("fact_invoice_lines", "dim_customer", "dim_product")}
        ).query(["Invoice Year"], ["Line Count", "Net Revenue"]),
        "metric_month_range": lambda lake: lake.metrics.query(
            ["Invoice Month"], ["Net Revenue"],
            where=[("Invoice Month", ">=", dt.date(2000, 3, 1)),
                   ("Invoice Month", "<=", dt.date(2000, 11, 1))],
        ),
        "metric_where_text": lambda lake: lake.metrics.query(
            ["Product Tier"], ["Gross Revenue", "Units Sold"],
            where=["`Territory` LIKE 'US-%' AND `Invoice Year` > 1997"],
        ),
        "metric_where_literal": lambda lake: lake.metrics.query(
            ["Customer Segment"], ["Net Revenue", "Line Count"],
            where=["`Territory` <> 'see `Territory`' AND `customer`.country <> '`Country`'"],
        ),
        "metric_having": lambda lake: lake.metrics.query(
            ["Invoice Month", "Territory"], ["Net Revenue", "Invoice Count"],
            having="`Invoice Count` >= 20 AND `Net Revenue` > 0",
        ),
        "metric_rank": _ranked_lines,
        "rollup_total": lambda lake: _rollups(lake).query([], every),
        "rollup_all_by_territory_line": lambda lake: _rollups(lake).query(
            ["Territory", "Product Line"], every
        ),
        "rollup_where_text": lambda lake: _rollups(lake).query(
            ["Product Line"], ["Gross Revenue", "Invoice Count", "Active Customers"],
            where=["`Territory` LIKE 'US-%'", ("Invoice Month", ">=", dt.date(2000, 3, 1))],
        ),
    }
    return found


@functools.lru_cache(maxsize=4)
def _rollups(lake: Lakehouse) -> Rollups:
    """Every measure by month, territory and product line, written once."""
    made = rollup(
        lake.metrics, ["Invoice Month", "Territory", "Product Line"], list(lake.metrics.view.measures),
        near="source.invoice_date",
    )
    return Rollups(lake.metrics, [written(made, "rollup")])


def _ranked_lines(lake: Lakehouse) -> DataFrame:
    """The two best months of each product line."""
    monthly = lake.metrics.query(["Product Line", "Invoice Month"], ["Net Revenue"])
    order = Window.partitionBy("Product Line").orderBy(F.desc("Net Revenue"), "Invoice Month")
    return monthly.withColumn("place", F.row_number().over(order)).filter("place <= 2")


def _as(lake: Lakehouse, name: str | None, *groups: str) -> Lakehouse:
    return lake.read_as(Identity("reader@example.com", name, frozenset(groups)))


def _governance() -> dict:
    def masked(lake, mask):
        table, key, column = MASKED[mask]
        return secure(lake.table(table), table, {"rows:*"}).select(key, column)

    found = {f"mask_{m}": lambda lake, m=m: masked(lake, m) for m in MASKED}
    found |= {
        f"rls_{p.lower()}": lambda lake, p=p: _as(lake, p).table("dim_customer").drop(
            dims.LOADED_AT
        )
        for p in PERSONAS
    }
    return found | {
        "rls_gl_regional": lambda lake: _as(lake, "REGIONAL_MGR_US_WEST").table(
            "vw_finance_kpis"
        ),
        "rls_group_fallback": lambda lake: _as(lake, None, "canada_east", "sales_leader").table(
            "vw_dim_customer"
        ),
        "rls_unknown_persona": _hidden_from_strangers,
        "rls_admin_group_policy": lambda lake: lake.read_as(
            Identity("reader@example.com", "HR", frozenset({"admins"})), GROUP_POLICY
        ).table("vw_dim_employee"),
        "persona_active": lambda lake: persona.active(lake.bronze("personas")),
        "persona_set": lambda lake: persona.upsert(lake.bronze("personas"), _signups(lake)),
        "persona_invalid": lambda lake: persona.invalid_rows(lake.bronze("personas")),
        "gov_user_privileges": lambda lake: user_privileges(
            lake.landed.memberships(), PERSONA_POLICY
        ),
        "gov_matrix": lambda lake: persona_matrix(
            lake.spark, PERSONA_POLICY, PERSONAS,
            {t: lake.table(t) for t in ("dim_customer", "dim_employee", "fact_gl_transactions")},
        ),
        "gov_sales_summary_regional": lambda lake: _as(lake, "REGIONAL_MGR_CA_WEST").table(
            "mv_sales_summary"
        ),
        "gov_metric_regional": lambda lake: _as(lake, "REGIONAL_MGR_US_EAST").metrics.query(
            ["Territory"], ["Net Revenue", "Line Count"]
        ),
        "gov_dashboard_regional": lambda lake: dashboards.tile(
            _as(lake, "REGIONAL_MGR_US_EAST"), "customer", "ltv_by_segment_territory"
        ),
        "bq15_visible_customers": lambda lake: questions.visible_customers(
            _as(lake, "REGIONAL_MGR_US_EAST")
        ),
        "bq15_visible_contacts": lambda lake: questions.visible_contacts(
            _as(lake, "SALES_LEADER")
        ),
    }


def _hidden_from_strangers(lake: Lakehouse) -> DataFrame:
    """Customers per territory, and how many of them a persona without grants sees."""
    def count(reader: Lakehouse, name: str) -> DataFrame:
        return reader.table("dim_customer").groupBy("territory").agg(F.count("*").alias(name))

    everyone = count(lake, "customers")
    seen = count(_as(lake, "VISITOR"), "visible").withColumnRenamed("territory", "place")
    return everyone.join(seen, F.col("territory").eqNullSafe(F.col("place")), "left").select(
        "territory", "customers", F.coalesce("visible", F.lit(0)).alias("visible")
    )


def _signups(lake: Lakehouse) -> DataFrame:
    """Persona changes: whoever fills in a contact form becomes a sales representative."""
    return lake.landed.raw("events").filter("event_type = 'signup'").select(
        F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit("@example.com"))
        .alias("user_email"),
        F.lit("SALES_REP").alias("persona"),
        F.col("ts").alias("set_at"),
    )


def _dashboards() -> dict:
    found = {
        f"ds_{n}": lambda lake, n=n: lake.table(n)
        for n in ("invoices", "gl", "web", "crm", "customers_360", "ar")
    }
    for page, spec in dashboards.PAGES.items():
        found |= {
            f"dash_{page}_{n}": lambda lake, p=page, n=n: dashboards.tile(lake, p, n)
            for n in spec.tiles
        }
        found |= {
            f"flt_{page}_{f.column}": lambda lake, p=page, c=f.column: dashboards.options(
                lake, p, c, dashboards.PAGES[p].example
            )
            for f in spec.filters
        }
    for page in dashboards.PAGES:
        found[f"page_{page}"] = lambda lake, p=page: dashboards.page_values(lake, p)
        found[f"facets_{page}"] = lambda lake, p=page: dashboards.page_options(
            lake, p, dashboards.PAGES[p].example
        )
    return found | {
        f"flt_{kind}": lambda lake, p=page, n=name: dashboards.tile(
            lake, p, n, dashboards.PAGES[p].example
        )
        for kind, page, name in [
            ("range_and_values", "executive", "margin_by_line_tier"),
            ("values", "finance", "amount_by_month_category"),
            ("one_of_several_datasets", "executive", "open_pipeline"),
            ("with_null", "customer", "ar_by_bucket_segment"),
            ("open_range", "marketing", "event_funnel"),
        ]
    }


def _written() -> dict:
    return {
        "matview_sales_summary": _refreshed_summary,
        "matview_finds_months": _summary_after_changes,
        "lake_reopened_summary": lambda lake: _opened(lake)[1].table("mv_sales_summary"),
        "lake_published_customers": _published_customers,
    }


@functools.lru_cache(maxsize=4)
def _opened(lake: Lakehouse) -> tuple[Catalog, Lakehouse]:
    """The lakehouse built into a folder of its own and opened again from there."""
    name = uuid.uuid4().hex
    catalog = Catalog(lake.spark, f"lake_{name}_", f"{shared_dir(lake.spark)}/builds-{name}")
    lake.build(catalog)
    return catalog, Lakehouse.open(catalog, metric_view=lake.metric_view)


def _published_customers(lake: Lakehouse) -> DataFrame:
    """The published customers as whoever runs the query sees them, under two personas in turn."""
    catalog, _ = _opened(lake)
    governance, seen = Governance(catalog), []
    me = lake.spark.sql("SELECT current_user()").first()[0]
    for persona in ("HR", "REGIONAL_MGR_US_EAST"):
        governance.set_persona(me, persona, dt.datetime.now())
        shown = lake.spark.table(f"{catalog.prefix}silver.dim_customer").select(
            F.lit(persona).alias("persona"), "customer_key", "email", "phone", "territory"
        )
        seen.append(written(shown, "published"))  # the view asks for the persona when it is read
    return seen[0].unionByName(seen[1])


def _refreshed_summary(lake: Lakehouse) -> DataFrame:
    """The sales summary written as a materialized view, then three months rebuilt."""
    def define(months):
        fact = lake.table("fact_invoice_lines")
        if months is not None:
            fact = in_months(fact, "invoice_date", months)
        summary = gold.sales_summary(fact, lake.table("dim_customer"), lake.table("dim_product"))
        return published(summary)

    path = f"{shared_dir(lake.spark)}/mv_sales_summary-{uuid.uuid4().hex}"
    view = MaterializedView(lake.spark, path, define)
    view.refresh()
    view.refresh([month_start(AS_OF, -i) for i in range(3)])
    return view.read()


def _summary_after_changes(lake: Lakehouse) -> DataFrame:
    """The sales summary of lines that change between two refreshes, each of which finds its months.

    At first the lines of one month are missing and those of another have no discount.
    """
    # the joins that make the lines run once; both refreshes read what is written, as they find it
    lines = written(lake.table("fact_invoice_lines").drop(dims.LOADED_AT), "changing-lines")
    month = month_of("invoice_date")
    early = lines.filter(month != month_start(AS_OF, -5)).withColumn("discount_amount", F.when(
        month == month_start(AS_OF, -30), F.lit(0).cast(lines.schema["discount_amount"].dataType)
    ).otherwise(F.col("discount_amount")))
    held = {"lines": early}
    customer = lake.table("dim_customer").select("customer_key", "territory", "customer_segment")
    product = lake.table("dim_product").select(
        "product_key", "product_line", "product_tier", "unit_cost_usd"
    )

    def define(months):
        fact = held["lines"]
        if months is not None:
            fact = in_months(fact, "invoice_date", months)
        return published(gold.sales_summary(fact, customer, product))

    view = MaterializedView(
        lake.spark, f"{shared_dir(lake.spark)}/mv_found-{uuid.uuid4().hex}", define,
        sources=lambda: {"lines": (held["lines"], "invoice_date"), "customer": (customer, None),
                         "product": (product, None)},
    )
    view.refresh()
    held["lines"] = lines
    view.refresh()
    return view.read()
