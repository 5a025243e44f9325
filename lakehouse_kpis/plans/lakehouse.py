"""The medallion flow as lazy frames: landed tables -> silver -> gold, metrics, datasets."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession

from lakehouse_kpis.catalog import Catalog, month_partition
from lakehouse_kpis.functions.money import published
from lakehouse_kpis.governance.policy import PERSONA_POLICY, PROTECTED, Identity, Policy, secure
from lakehouse_kpis.governance.views import Governance
from lakehouse_kpis.operators import dims, facts, gold
from lakehouse_kpis.operators.metrics import Metrics, MetricView
from lakehouse_kpis.plans import datasets
from lakehouse_kpis.plans.sales_metrics import SALES_METRICS
from lakehouse_kpis.session import shuffles_dropped

# provenance of the landed tables
PROVENANCE = {
    "products": {"source_system": "D365_FO"},
    "customers": {"source_system": "D365_FO", "contains_pii": "true"},
    "invoice_lines": {"source_system": "D365_FO"},
    "markups": {"source_system": "D365_FO"},
    "dimension_values": {"source_system": "D365_FO"},
    "legacy_headers": {"source_system": "AX_2012", "is_legacy": "true"},
    "gl": {"source_system": "AX_2012", "is_legacy": "true"},
    "employees": {"source_system": "UKG", "contains_pii": "true"},
    "deals": {"source_system": "HubSpot"},
    "sessions": {"source_system": "GoogleAnalytics"},
}
FACT_DATES = {
    "fact_invoice_lines": "invoice_date",
    "fact_gl_transactions": "transaction_date",
    "fact_web_engagement": "session_date",
    "fact_crm_deals": "created_at",
}


# the days that the calendar covers
LANDED_DATES = {
    "invoice_lines": "INVOICEDATE", "legacy_headers": "INVOICEDATE", "gl": "TRANSDATE",
    "sessions": "SESSION_DATE", "deals": "CREATED_AT",
}
# what a silver table is made from
INPUTS = {
    "dim_customer": ("customers",), "dim_product": ("products",), "dim_employee": ("employees",),
    "dim_date": tuple(LANDED_DATES),
    "fact_invoice_lines": ("invoice_lines", "markups", "legacy_headers", "products"),
    "fact_gl_transactions": ("gl",), "fact_web_engagement": ("sessions",), "fact_crm_deals": ("deals",),
}
# marts that are written; directories are views over the published dimensions
STORED_MARTS = ("mv_sales_summary", "vw_customer_360", "vw_finance_kpis", "vw_ar_aging")
DIRECTORIES = {
    "vw_dim_customer": ("dim_customer", gold.CUSTOMER_COLUMNS),
    "vw_dim_employee": ("dim_employee", gold.EMPLOYEE_COLUMNS),
}
# published tables that show a reader what the rules of a protected table leave; ageing is by customer
# key alone and comes from no protected table
SECURED = {name: name for name in PROTECTED} | {
    "mv_sales_summary": "dim_customer", "vw_customer_360": "dim_customer",
    "vw_finance_kpis": "fact_gl_transactions",
}


class Lakehouse:
    """All layers over one set of landed tables, each frame made when first asked for.

    With an identity, every table is read as that reader may see it, and so is everything
    above it; without one the tables are raw, for building and for the owner.
    """

    def __init__(
        self, spark: SparkSession, landed, as_of: dt.date, web_as_of: dt.date | None = None,
        identity: Identity | None = None, policy: Policy = PERSONA_POLICY,
        allocation: str = "repeat", legacy_product: Column | None = None,
        metric_view: MetricView = SALES_METRICS,
        stored: Mapping[str, DataFrame] | None = None, spread: int = facts.SPREAD,
    ):
        self.spark, self.landed, self.as_of = spark, landed, as_of
        self.web_as_of = web_as_of or as_of
        self.identity, self.policy, self.allocation = identity, policy, allocation
        self.legacy_product, self.metric_view = legacy_product, metric_view
        self.stored, self.spread = dict(stored or {}), spread
        self._raw: dict[str, DataFrame] = {}
        self._frames: dict[str, DataFrame] = {}
        self._metrics: Metrics | None = None

    def read_as(self, identity: Identity, policy: Policy | None = None) -> Lakehouse:
        """The same lakehouse as another reader sees it."""
        reader = Lakehouse(
            self.spark, self.landed, self.as_of, self.web_as_of, identity,
            policy or self.policy, self.allocation, self.legacy_product, self.metric_view,
            self.stored, self.spread,
        )
        reader._raw = self._raw
        return reader

    def bronze(self, name: str) -> DataFrame:
        return self.landed.table(name)

    def table(self, name: str) -> DataFrame:
        """A silver table, a gold mart or a dashboard dataset, by name."""
        if name not in self._frames:
            if name in _SILVER:
                frame = self._protected(name)
            elif name in _GOLD:
                frame = _GOLD[name](self)
            elif name in datasets.DATASETS:
                frame = datasets.DATASETS[name](self)
            else:
                raise KeyError(f"unknown table {name!r}")
            self._frames[name] = frame
        return self._frames[name]

    @property
    def metrics(self) -> Metrics:
        if self._metrics is None:
            self._metrics = self.metric_view.bind(_Tables(self))
        return self._metrics

    def _protected(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = self.stored[name] if name in self.stored else _SILVER[name](self)
        raw = self._raw[name]
        if self.identity is None or name not in PROTECTED:
            return raw
        return secure(raw, name, self.policy.privileges(self.identity))

    def build(
        self, catalog: Catalog, invoice_buckets: int | None = None, at_once: int = 4,
        keep: int = 1,
    ) -> Lakehouse:
        """Write bronze, silver and gold as a new build, publish it, and read on from it.

        The tables of the build before stay as they are until the new ones are whole; then all names
        are switched, and builds but the `keep` before are dropped. The landed tables may be those of
        an earlier build (`open(catalog).build(catalog)`). The published names of protected tables
        and marts show every reader what their persona and groups open (`governance.views`).

        invoice_buckets: bucket invoice lines, charges and headers by invoice, so that the
        charges are joined to the lines without a shuffle of the landed tables. A bucket is
        one task, so leave it out when one invoice may hold a large part of the lines.
        at_once: tables written side by side; a silver table starts once its own inputs are there.
        """
        build = catalog.begin()
        governance = Governance(catalog)
        governance.ensure(self.policy)
        by_invoice = ("invoice_lines", "markups", "legacy_headers")
        source = getattr(self.landed, "path", None)

        def land(name: str) -> None:
            bucketed = invoice_buckets and name in by_invoice
            where = {"source_path": f"{source}/{name}"} if source else {}
            build.publish(
                self.bronze(name), "bronze", name, f"landed {name}", PROVENANCE[name] | where,
                bucket_by=(invoice_buckets, ["INVOICEID"]) if bucketed else None,
            )

        written = Lakehouse(
            self.spark, _CatalogTables(build), self.as_of, self.web_as_of, None, self.policy,
            self.allocation, self.legacy_product, self.metric_view,
            spread=1 if invoice_buckets else self.spread,
        )

        def conform(name: str) -> DataFrame:
            for landed in INPUTS.get(name, ()):
                landing[landed].result()
            date = FACT_DATES.get(name)
            private = {"contains_pii": "true"} if name in PROTECTED and PROTECTED[name].masks else {}
            return build.publish(
                written.table(name), "silver", name, f"conformed {name}",
                {"built_from": ", ".join(INPUTS.get(name, ("rules",)))} | private,
                partition_by=month_partition(date) if date else None,
            )

        # one switch for all writes, as they share the session's settings
        with shuffles_dropped(self.spark), ThreadPoolExecutor(at_once) as pool:
            # landing tasks come first in the pool's queue, so what a silver table waits for runs
            landing = {name: pool.submit(land, name) for name in _largest_first(PROVENANCE)}
            conforming = {name: pool.submit(conform, name) for name in _largest_first(_SILVER)}
            for task in landing.values():
                task.result()
            stored = {name: task.result() for name, task in conforming.items()}
            built = self._over(build, stored)
            marts = dict(zip(STORED_MARTS, pool.map(lambda name: build.publish(
                published(built.table(name)), "gold", name, f"mart {name}"
            ), STORED_MARTS)))
        secured = {
            name: governance.secured(rules, (stored | marts)[name].columns)
            for name, rules in SECURED.items()
        }
        build.commit({"as_of": self.as_of.isoformat(), "web_as_of": self.web_as_of.isoformat(),
                      "allocation": self.allocation}, secured)
        self._publish_views(catalog)
        catalog.drop_old(keep)
        return built

    def _over(self, build: Catalog, stored: Mapping[str, DataFrame]) -> Lakehouse:
        return Lakehouse(
            self.spark, _CatalogTables(build), self.as_of, self.web_as_of, self.identity, self.policy,
            self.allocation, self.legacy_product, self.metric_view.verified(stored), stored,
        )

    @classmethod
    def open(
        cls, catalog: Catalog, policy: Policy = PERSONA_POLICY,
        metric_view: MetricView = SALES_METRICS, legacy_product: Column | None = None,
    ) -> Lakehouse:
        """The last finished build, in this application or another, without its sources.

        The lakehouse stays with that build: later ones do not change what it reads.
        """
        Governance(catalog).ensure(policy)  # what the published views ask
        build, settings = catalog.open()
        lake = cls(
            catalog.spark, _CatalogTables(build), dt.date.fromisoformat(settings["as_of"]),
            dt.date.fromisoformat(settings["web_as_of"]), None, policy, settings["allocation"],
            legacy_product, metric_view,
        )
        lake._publish_views(catalog)
        return lake._over(build, {name: build.read("silver", name) for name in build.tables("silver")})

    def _publish_views(self, catalog: Catalog) -> None:
        """Directories as views of the published dimensions, which follow the reader."""
        for view, (table, columns) in DIRECTORIES.items():
            self.spark.sql(
                f"CREATE OR REPLACE VIEW {catalog.prefix}gold.{view} AS "
                f"SELECT {', '.join(columns)} FROM {catalog.prefix}silver.{table}"
            )

    def register_views(self, catalog: Catalog) -> None:
        """Every silver table and gold mart as a view, for queries written in SQL."""
        for name in [*_SILVER, *_GOLD]:
            catalog.view(name, self.table(name))


def _largest_first(names: Iterable[str]) -> list[str]:
    """The tables that take longest first."""
    large = ["gl", "invoice_lines", "fact_gl_transactions", "fact_invoice_lines"]
    return sorted(names, key=lambda n: n not in large)


class _Tables(Mapping):
    """The tables of a lakehouse as a mapping, still made on demand."""

    def __init__(self, lake: Lakehouse):
        self.lake = lake

    def __getitem__(self, name: str) -> DataFrame:
        return self.lake.table(name)

    def __iter__(self) -> Iterator[str]:
        return iter([*_SILVER, *_GOLD])

    def __len__(self) -> int:
        return len(_SILVER) + len(_GOLD)


class _CatalogTables:
    def __init__(self, catalog: Catalog):
        self.catalog = catalog

    def table(self, name: str) -> DataFrame:
        return self.catalog.read("bronze", name)


_SILVER = {
    "dim_customer": lambda lake: dims.dim_customer(lake.bronze("customers")),
    "dim_product": lambda lake: dims.dim_product(lake.bronze("products")),
    "dim_employee": lambda lake: dims.dim_employee(lake.bronze("employees")),
    "dim_region": lambda lake: dims.dim_region(lake.spark),
    "dim_date": lambda lake: dims.dim_date_over([
        lake.bronze(name).select(date) for name, date in LANDED_DATES.items()
    ]),
    "fact_invoice_lines": lambda lake: facts.fact_invoice_lines(
        lake.bronze("invoice_lines"), lake.bronze("markups"), lake.bronze("legacy_headers"),
        lake.allocation, lake.legacy_product, lake.spread, lake.bronze("products"),
    ),
    "fact_gl_transactions": lambda lake: facts.fact_gl_transactions(lake.bronze("gl")),
    "fact_web_engagement": lambda lake: facts.fact_web_engagement(lake.bronze("sessions")),
    "fact_crm_deals": lambda lake: facts.fact_crm_deals(lake.bronze("deals")),
}

_GOLD = {
    "vw_dim_customer": lambda lake: gold.customer_directory(lake.table("dim_customer")),
    "vw_dim_employee": lambda lake: gold.employee_directory(lake.table("dim_employee")),
    "mv_sales_summary": lambda lake: gold.sales_summary(
        lake.table("fact_invoice_lines"), lake.table("dim_customer"), lake.table("dim_product")
    ),
    "vw_finance_kpis": lambda lake: gold.finance_kpis(lake.table("fact_gl_transactions")),
    "vw_customer_360": lambda lake: gold.customer_360(
        lake.table("dim_customer"), lake.table("fact_invoice_lines"),
        lake.table("fact_crm_deals"),
    ),
    "vw_ar_aging": lambda lake: gold.ar_aging(lake.table("fact_invoice_lines"), lake.as_of),
}
