"""The unified invoice lines kept month by month: a refresh rebuilds what newly landed rows change."""

from __future__ import annotations

import datetime as dt
import functools
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakehouse_kpis.functions.dates import month_of
from lakehouse_kpis.operators import facts
from lakehouse_kpis.operators.matview import (
    KEPT, NO_MONTH, WHOLE, MaterializedView, by_month, in_months, signature,
)

MONTH = "invoice_month"


class InvoiceFact(MaterializedView):
    """`fact_invoice_lines`, stored by month, refreshed from the landed tables.

    `landed(name)` gives the landed rows as they are now. A refresh rebuilds the months

    * whose lines have changed: their number, or the latest sink time of one. Two columns are read;
    * whose legacy headers have changed, by signatures of whole rows;
    * of the invoices whose charges have changed, however late or back-dated a charge is: the charges
      per invoice are compared with those of the last refresh, and looked up in two columns of the lines;
    * of all legacy headers, if their stand-in products come from a product table with other keys now;
    * with allocation="equal" also the other months of invoices that lie in several, as a new line
      changes the shares of all.

    Lines and headers of other months are not read to rebuild; charges are cut to the invoices of the
    months before they are summed. The lines must have a new sink time whenever a row is written again.
    """

    def __init__(
        self, spark: SparkSession, path: str, landed: Callable[[str], DataFrame],
        allocation: str = "repeat", product_key: Column | None = None,
    ):
        super().__init__(spark, path, self._define, MONTH)
        self.landed, self.allocation, self.product_key = landed, allocation, product_key
        self._given = False

    def refresh(self, months: Sequence[dt.date] | None = None) -> list[str] | None:
        self._given = months is not None
        rebuilt = super().refresh(months)
        if rebuilt == []:
            self._files.delete(f"charges/{self._snapshot}")
        return rebuilt

    # --- what has changed -------------------------------------------------------------------

    def _signatures(self) -> dict[str, dict[str, list[str]]]:
        lines, month = self.landed("invoice_lines"), _month("INVOICEDATE")
        counts = lines.groupBy(month.alias("month")).agg(
            F.count("*").alias("n"), F.max("_SINKMODIFIEDTIME").alias("t")
        )
        self._snapshot = uuid.uuid4().hex
        facts.markup_pivot(self.landed("markups")).write.parquet(self._charges_at(self._snapshot))
        found = {
            "lines": by_month(counts, "n", "t"),
            "headers": signature(self.landed("legacy_headers"), "INVOICEDATE"),
            "charges": {WHOLE: [self._snapshot]},
        }
        if self.product_key is None:
            found["products"] = signature(self.landed("products").select("ITEMID"), None)
        return found

    def _changed(self, state: dict, now: dict) -> list[dt.date] | None:
        before = state["signatures"]
        if before.keys() != now.keys():
            return None
        months = {
            m for name in ("lines", "headers") for m in before[name].keys() | now[name].keys()
            if before[name].get(m) != now[name].get(m)
        }
        if before.get("products") != now.get("products"):
            months |= before["headers"].keys() | now["headers"].keys()
        old, new = (
            self.spark.read.parquet(self._charges_at(s["charges"][WHOLE][0])) for s in (before, now)
        )
        held = F.struct(*facts.CHARGES)
        changed = old.select("INVOICEID", held.alias("old")).join(
            new.select("INVOICEID", held.alias("new")), "INVOICEID", "full"
        ).where("NOT old <=> new").select("INVOICEID")
        months |= self._months_with(changed)
        if self.allocation == "equal" and months and NO_MONTH not in months:
            # the invoices of these months, as they were and as they are
            days = [dt.date.fromisoformat(m) for m in months]
            there = self._dated(days).select("INVOICEID")
            stored = self.read().where(F.col(MONTH).isin(days)).select(
                F.col("invoice_id").alias("INVOICEID")
            )
            months |= self._months_with(there.union(stored).distinct())
        if NO_MONTH in months:
            return None
        return [dt.date.fromisoformat(m) for m in sorted(months)]

    def _merged(self, before: dict, now: dict, months: Sequence[str]) -> dict:
        merged = super()._merged(before, now, months)
        # whole-table entries: months given by hand leave what else has changed to be found later
        for name in {"charges", "products"} & now.keys():
            merged[name] = before.get(name, {}) if self._given else now[name]
        return merged

    def _dated(self, months: Sequence[dt.date] | None = None) -> DataFrame:
        """INVOICEID and INVOICEDATE of lines and headers."""
        both = [
            self._part(name, months).select("INVOICEID", "INVOICEDATE")
            for name in ("invoice_lines", "legacy_headers")
        ]
        return functools.reduce(DataFrame.unionByName, both)

    def _months_with(self, invoices: DataFrame) -> set[str]:
        found = self._dated().join(invoices, "INVOICEID", "left_semi")
        return set(by_month(found.select(_month("INVOICEDATE").alias("month")).distinct()))

    # --- rebuilding -------------------------------------------------------------------------

    def _part(self, name: str, months: Sequence[dt.date] | None) -> DataFrame:
        rows = self.landed(name)
        return rows if months is None else in_months(rows, "INVOICEDATE", months)

    def _define(self, months: Sequence[dt.date] | None) -> DataFrame:
        needed = months
        if months is not None and self.allocation == "equal":
            # an invoice is divided over all its lines, also those of other months
            inside = self._dated(months).select("INVOICEID").distinct()
            found = self._months_with(inside) - {NO_MONTH}
            needed = sorted({dt.date.fromisoformat(m) for m in found} | set(months))
        charges = self.landed("markups")
        if needed is not None:
            charges = charges.join(
                self._dated(needed).select("INVOICEID").distinct(), "INVOICEID", "left_semi"
            )
        fact = facts.fact_invoice_lines(
            self._part("invoice_lines", needed), charges, self._part("legacy_headers", needed),
            self.allocation, self.product_key, products=self.landed("products"),
        ).withColumn(MONTH, F.trunc("invoice_date", "MONTH"))
        return fact if months is None else fact.where(F.col(MONTH).isin(list(months)))

    # --- snapshots of the charges -----------------------------------------------------------

    def _charges_at(self, snapshot: str) -> str:
        return f"{self.path}/charges/{snapshot}"

    def _switch(self, number: int, state: dict) -> None:
        def held(states: list[dict]) -> set[str]:
            return {s["signatures"]["charges"][WHOLE][0] for s in states if s["signatures"].get("charges")}

        older = [self._stored(n) for n in self._numbers()]
        super()._switch(number, state)
        for snapshot in held(older) - held([*older[1 - KEPT:], state]):
            self._files.delete(f"charges/{snapshot}")


def _month(date: str) -> Column:
    return F.coalesce(month_of(date).cast("string"), F.lit(NO_MONTH))
