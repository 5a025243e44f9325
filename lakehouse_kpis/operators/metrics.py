"""Metric views: dimensions and measures declared once, evaluated at any query grain.

A measure is an aggregate expression, or an expression over other measures named in
back-ticks. At query time the expressions go to Catalyst as they are:
filter -> left joins that the query needs -> groupBy(dimensions).agg(measures).
"""

from __future__ import annotations

import datetime as dt
import functools
import operator
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakehouse_kpis.functions.dates import month_start
from lakehouse_kpis.functions.money import published
from lakehouse_kpis.operators.dims import dedupe_latest
from lakehouse_kpis.operators.ranges import between

COMPARE = {
    "=": operator.eq, "<>": operator.ne, "<": operator.lt, "<=": operator.le,
    ">": operator.gt, ">=": operator.ge,
}
# a string literal, which is left as it is, or a name in back-ticks
NAMED = re.compile(r"'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\"|`([^`]+)`", re.DOTALL)


def _mentions(table: str, text: str) -> bool:
    """Whether an expression names a column of the table, its alias quoted or not."""
    return re.search(rf"(?<!\w)`?{re.escape(table)}`?\s*\.", text, re.IGNORECASE) is not None


@dataclass(frozen=True)
class Join:
    """Left join of a dimension, at most one match per source row.

    on_duplicate: "error" stops a query whose dimension key is not unique, "first" keeps
    the first row per key in `order`, "trust" takes the word of whoever wrote the table and
    spares the check.
    """

    name: str
    source: str
    on: str
    on_duplicate: str = "error"
    order: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if self.on_duplicate not in ("error", "first", "trust"):
            raise ValueError(f"join {self.name!r}: on_duplicate={self.on_duplicate!r}")

    @property
    def keys(self) -> list[str]:
        own = rf"(?<!\w)`?{re.escape(self.name)}`?\s*\.\s*`?(\w+)`?"
        return re.findall(own, self.on, re.IGNORECASE)

    def most_copies(self, table: DataFrame) -> DataFrame:
        """One row: how often the most frequent key occurs. NULL keys never match."""
        known = functools.reduce(operator.and_, [F.col(k).isNotNull() for k in self.keys])
        copies = table.filter(known).groupBy(*self.keys).agg(F.count("*").alias("copies"))
        return copies.agg(F.max("copies"))


@dataclass(frozen=True)
class Dimension:
    """truncates=("invoice_date", "MONTH"): the expression is that source column cut to its
    month (or "YEAR": its year number), so that a filter on the dimension can be turned into
    a filter on the column, which reaches the scan."""

    name: str
    expr: str
    truncates: tuple[str, str] | None = None


@dataclass(frozen=True)
class Measure:
    name: str
    expr: str
    # cheaper expression for queries that ask for approximate results
    approximate: str | None = None


@dataclass(frozen=True)
class MetricView:
    source: str
    dimensions: Mapping[str, Dimension]
    measures: Mapping[str, Measure]
    joins: tuple[Join, ...] = ()
    filter: str | None = None
    version: str = "0.1"

    @classmethod
    def from_dict(cls, spec: Mapping[str, Any]) -> MetricView:
        def named(kind, entries):
            made = [kind(**{k: tuple(v) if isinstance(v, list) else v for k, v in e.items()})
                    for e in entries]
            if len({m.name for m in made}) < len(made):
                raise ValueError(f"a {kind.__name__.lower()} is defined twice")
            return {m.name: m for m in made}

        return cls(
            source=spec["source"],
            dimensions=named(Dimension, spec.get("dimensions", [])),
            measures=named(Measure, spec.get("measures", [])),
            joins=tuple(named(Join, spec.get("joins", [])).values()),
            filter=spec.get("filter"),
            version=str(spec.get("version", "0.1")),
        )

    @classmethod
    def from_yaml(cls, text: str) -> MetricView:
        try:
            import yaml
        except ImportError as error:
            raise ImportError("from_yaml needs PyYAML; use from_dict") from error
        return cls.from_dict(yaml.safe_load(text))

    def verified(self, tables: Mapping[str, DataFrame]) -> MetricView:
        """The view for tables that were just written: a join whose key is found unique now
        is not checked again by every query. Reads one row per join."""
        def check(join: Join) -> Join:
            if join.on_duplicate != "error":
                return join
            most = join.most_copies(tables[join.source]).first()[0]
            return replace(join, on_duplicate="trust") if (most or 0) <= 1 else join

        return replace(self, joins=tuple(check(j) for j in self.joins))

    def bind(self, tables: Mapping[str, DataFrame]) -> Metrics:
        """Attach frames to the names that `source` and the joins use."""
        return Metrics(self, tables)


@dataclass
class Metrics:
    view: MetricView
    tables: Mapping[str, DataFrame]
    _checked: dict[str, DataFrame] = field(default_factory=dict)

    def query(
        self,
        dims: Sequence[str] = (),
        measures: Sequence[str] = (),
        where: Sequence[str | tuple[str, str, Any]] = (),
        having: str | None = None,
        order_by: Sequence[str] = (),
        limit: int | None = None,
        approximate: bool = False,
    ) -> DataFrame:
        """Measures grouped by dims.

        where: conditions before aggregation, each either SQL text with dimension names in
        back-ticks or (dimension, operator, value). having: SQL text over the result
        columns. order_by: result columns, "-name" for descending.
        """
        groups = {name: self.dimension(name).expr for name in dims}
        totals = {name: self._measure(name, approximate) for name in measures}
        conditions = [self._condition(w) for w in where]
        texts = [*groups.values(), *totals.values(), *[text for text, _ in conditions]]

        rows = self.rows(texts)
        for _, condition in conditions:
            rows = rows.filter(condition)
        result = rows.groupBy(*[F.expr(e).alias(n) for n, e in groups.items()]).agg(
            *[F.expr(e).alias(n) for n, e in totals.items()]
        )
        return published(finished(result, having, order_by, limit))

    def rows(self, texts: Sequence[str]) -> DataFrame:
        """The filtered source with the joins that any of the expressions mentions.

        Leaving out a join changes nothing else, because it matches at most once and drops
        no row.
        """
        rows = self.tables[self.view.source].alias("source")
        floor = self.view.filter or ""
        early = floor and not any(_mentions(j.name, floor) for j in self.view.joins)
        if early:
            rows = rows.filter(floor)
        used: list[Join] = []
        for join in reversed(self.view.joins):
            later = [*texts, floor, *[j.on for j in used]]
            if any(_mentions(join.name, text) for text in later):
                used.insert(0, join)
        for join in used:
            table = self.tables[join.source]
            if join.on_duplicate == "first":
                table = dedupe_latest(table, join.keys, [F.expr(o) for o in join.order])
            elif join.on_duplicate == "error":
                rows = rows.filter(self._unique(join, table))
            rows = rows.join(table.alias(join.name), F.expr(join.on), "left")
        return rows.filter(floor) if floor and not early else rows

    def _unique(self, join: Join, table: DataFrame) -> Column:
        """True, or an error when the key of the dimension is not unique.

        The check is a one-row subquery next to the join. Inside the join it would hide the
        join's shuffle from AQE's skew handling.
        """
        if join.name not in self._checked:
            self._checked[join.name] = join.most_copies(table)
        most = F.coalesce(self._checked[join.name].scalar(), F.lit(0))
        message = f"join {join.name!r}: {', '.join(join.keys)} is not unique in {join.source}"
        return F.assert_true(most <= 1, message).isNull()

    def dimension(self, name: str) -> Dimension:
        try:
            return self.view.dimensions[name]
        except KeyError:
            raise KeyError(f"unknown dimension {name!r}") from None

    def _measure(self, name: str, approximate: bool, path: tuple[str, ...] = ()) -> str:
        """Expression of a measure with the measures it is built from put in."""
        if name not in self.view.measures:
            raise KeyError(f"unknown measure {name!r}")
        if name in path:
            raise ValueError(f"measure {name!r} is defined by itself")
        measure = self.view.measures[name]
        text = measure.approximate if approximate and measure.approximate else measure.expr

        def inner(match: re.Match) -> str:
            if match[1] not in self.view.measures:
                return match[0]
            return f"({self._measure(match[1], approximate, (*path, name))})"

        return NAMED.sub(inner, text)

    def _condition(self, where: str | tuple[str, str, Any]) -> tuple[str, Column]:
        if isinstance(where, str):
            text = NAMED.sub(
                lambda m: f"({self.dimension(m[1]).expr})"
                if m[1] in self.view.dimensions else m[0],
                where,
            )
            return text, F.expr(text)
        name, op, value = where
        dimension = self.dimension(name)
        if dimension.truncates:
            column, grain = dimension.truncates
            bounds = _span(op, value, grain)
            if bounds is not None:
                columns = self.tables[self.view.source].columns
                return "", between(column, *bounds, columns, prefix="source.")
        return dimension.expr, COMPARE[op](F.expr(dimension.expr), F.lit(value))


def finished(
    result: DataFrame, having: str | None, order_by: Sequence[str], limit: int | None
) -> DataFrame:
    """What is asked of a result after it is aggregated."""
    if having:
        result = result.filter(having)
    if order_by:
        result = result.orderBy(*[
            F.desc_nulls_last(f"`{n[1:]}`") if n.startswith("-") else F.asc(f"`{n}`")
            for n in order_by
        ])
    return result if limit is None else result.limit(limit)


def _span(op: str, value: Any, grain: str) -> tuple[dt.date | None, dt.date | None] | None:
    """Days d with cut(d) op value, as [low, high); None when they are no such range."""
    if grain == "YEAR" and isinstance(value, int):
        first, after = dt.date(value, 1, 1), dt.date(value + 1, 1, 1)
    elif grain == "MONTH" and isinstance(value, dt.date) and value.day == 1:
        first, after = month_start(value), month_start(value, 1)
    else:
        return None
    return {
        "=": (first, after), ">=": (first, None), ">": (after, None), "<": (None, first),
        "<=": (None, after),
    }.get(op)
