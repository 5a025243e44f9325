"""Stored rollups of a metric view, and queries answered from the smallest one that can.

A rollup holds the view's measures at some of its dimensions. Sums and counts roll up by adding.
Distinct counts roll up too, exactly: values are numbered once, and each cell keeps bitmaps of the
numbers that occur in it, so the count at a coarser grain is that of the bitmaps put together. No
query on a rollup reads the fact or a dimension.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakehouse_kpis.functions.money import published
from lakehouse_kpis.operators.metrics import COMPARE, NAMED, Metrics, MetricView, finished
from lakehouse_kpis.operators.numbering import numbered
from lakehouse_kpis.session import written

_SUM = re.compile(r"\s*sum\s*\((?!\s*distinct\b)(.*)\)\s*", re.IGNORECASE | re.DOTALL)
_COUNT = re.compile(r"\s*count\s*\((?!\s*distinct\b)(.*)\)\s*", re.IGNORECASE | re.DOTALL)
_DISTINCT = re.compile(r"\s*count\s*\(\s*distinct\b(.*)\)\s*", re.IGNORECASE | re.DOTALL)
COUNTED, BUCKET = "_counted", "_bucket"


def _whole(text: str) -> bool:
    """Whether the brackets of what stood between an outer pair match, so that it was one call."""
    depth = 0
    for mark in re.sub(r"'(?:[^'\\]|\\.)*'", "", text):
        depth += (mark == "(") - (mark == ")")
        if depth < 0:
            return False
    return depth == 0


def kind_of(expr: str) -> tuple[str, str] | None:
    """("sum" | "count" | "distinct", argument) of a measure that rolls up by itself, else None."""
    for kind, form in (("distinct", _DISTINCT), ("count", _COUNT), ("sum", _SUM)):
        match = form.fullmatch(expr)
        if match and _whole(match[1]):
            return kind, match[1].strip()
    return None


def _arguments(text: str) -> list[str]:
    """The arguments of a call, parted at the commas outside brackets and quotes."""
    parts, held = [], ""
    for piece in text.split(","):
        held = f"{held},{piece}" if held else piece
        if _whole(held) and not any(held.count(mark) % 2 for mark in "'`\""):
            parts.append(held)
            held = ""
    return parts + [held] * bool(held)


def _input(kind: str, argument: str) -> Column | None:
    """What a sum or a count takes from a row: the value, or 1 where no argument is null; None for *."""
    if kind == "sum":
        return F.expr(argument)
    if argument == "*":
        return None
    known = " AND ".join(f"({a}) IS NOT NULL" for a in _arguments(argument))
    return F.expr(f"CASE WHEN {known} THEN 1 END")


def parts_of(view: MetricView, measure: str) -> set[str]:
    """The measures that have to be stored for a measure: itself, or those that it is made from."""
    expr = view.measures[measure].expr
    if kind_of(expr):
        return {measure}
    inner = {m[1] for m in NAMED.finditer(expr) if m[1] in view.measures}
    if not inner:
        raise ValueError(f"measure {measure!r} does not roll up")
    return set().union(*[parts_of(view, name) for name in inner])


def rollup(
    metrics: Metrics, dims: Sequence[str], measures: Sequence[str], near: str | None = None
) -> DataFrame:
    """The rollup of `measures` at `dims`, to be written.

    Columns: the dimensions; the stored measures, distinct counts as bitmaps; and _counted (the measure
    of a row with a bitmap) and _bucket, which are null in the rows that hold sums. Measures that are made from others
    are not stored, as they follow from them. near: an expression over the source by whose least
    value counted values are numbered (the invoice date for invoices), so that the values of a cell
    lie close together and take few bitmaps.
    """
    view = metrics.view
    groups = {name: metrics.dimension(name).expr for name in dims}
    stored = sorted(set().union(*[parts_of(view, name) for name in measures]))
    kinds = {name: kind_of(view.measures[name].expr) for name in stored}
    added = {n: view.measures[n].expr for n, (kind, _) in kinds.items() if kind != "distinct"}
    counted = {n: arg for n, (kind, arg) in kinds.items() if kind == "distinct"}

    rows = metrics.rows([*groups.values(), *added.values(), *counted.values(), near or ""])
    keys = [F.expr(e).alias(n) for n, e in groups.items()]
    if counted and not any(arg.endswith(".*") for kind, arg in kinds.values() if kind == "count"):
        # sums and distinct counts are made from the same rows: the joins that make them run once
        inputs = {n: _input(*kinds[n]) for n in added}
        made = written(rows.select(
            *keys, *[c.alias(n) for n, c in inputs.items() if c is not None],
            *[F.expr(arg).alias(n) for n, arg in counted.items()],
            F.expr(near or "0").alias("_near"),
        ), "rolled-rows")
        metrics = MetricView("rolled", {}, {}).bind({"rolled": made})
        rows = metrics.rows([])
        groups = {n: f"`{n}`" for n in groups}
        keys = [F.col(e) for e in groups.values()]
        added = {n: f"{kinds[n][0]}({'*' if c is None else f'`{n}`'})" for n, c in inputs.items()}
        counted, near = {n: f"`{n}`" for n in counted}, "_near"
    # a cell without a sum to hold still is a row
    sums = rows.groupBy(*keys).agg(F.count("*").alias("_rows"), *[
        F.expr(e).alias(n) for n, e in added.items()
    ]).drop("_rows")
    none = {COUNTED: "string", BUCKET: "bigint"}
    out = sums.withColumns({n: F.lit(None).cast(t) for n, t in none.items()})
    for name, value in counted.items():
        out = out.unionByName(
            _bitmaps(metrics, groups, name, value, near), allowMissingColumns=True
        )
    return out


def _bitmaps(
    metrics: Metrics, groups: Mapping[str, str], name: str, value: str, near: str | None
) -> DataFrame:
    rows = metrics.rows([*groups.values(), value, near or ""])
    # a value counts once a cell, however many lines it has there: reduced before any join
    held = rows.filter(f"({value}) IS NOT NULL").groupBy(
        *[F.expr(e).alias(n) for n, e in groups.items()], F.expr(value).alias("_value")
    ).agg(F.min(F.expr(near) if near else F.lit(0)).alias("_near"))
    held = written(held, "counted")  # read twice
    values = held.groupBy("_value").agg(F.min("_near").alias("_near"))
    ids = numbered(values, ["_near", "_value"], "_id").select("_value", "_id")
    placed = held.join(ids, "_value").select(
        *[f"`{n}`" for n in groups], F.bitmap_bucket_number("_id").alias(BUCKET),
        F.bitmap_bit_position("_id").alias("_bit"),
    )
    # numbers are brought together before bitmaps are made: made first, each task would send a bitmap
    # of full size for nearly every cell, however few of its numbers the task holds
    cells = [f"`{n}`" for n in [*groups, BUCKET]]
    return placed.repartition(*cells).groupBy(*cells).agg(
        F.bitmap_construct_agg("_bit").alias(name)
    ).withColumn(COUNTED, F.lit(name))


@dataclass
class Rollups:
    """A metric view's queries, from stored rollups where one holds what is asked for.

    metrics: the view, for all other queries. stored: the written rollups, the smallest first.
    What a rollup shows is what its metrics saw: for a reader with row filters, give rollups that
    were made from that reader's tables.
    """

    metrics: Metrics
    stored: Sequence[DataFrame]

    def query(
        self,
        dims: Sequence[str] = (),
        measures: Sequence[str] = (),
        where: Sequence[str | tuple[str, str, Any]] = (),
        having: str | None = None,
        order_by: Sequence[str] = (),
        limit: int | None = None,
    ) -> DataFrame:
        """As `Metrics.query`, with the same result."""
        for name in dims:
            self.metrics.dimension(name)
        for table in self.stored:
            cells = self._cells(table, dims, measures, where)
            if cells is not None:
                result = self._answer(cells, dims, measures)
                return published(finished(result, having, order_by, limit))
        return self.metrics.query(dims, measures, where, having, order_by, limit)

    def _cells(
        self, table: DataFrame, dims: Sequence[str], measures: Sequence[str], where: Sequence
    ) -> DataFrame | None:
        """The rollup's rows that pass, or None if it does not hold what the query needs."""
        view = self.metrics.view
        try:
            stored = set().union(*[parts_of(view, name) for name in measures])
        except ValueError:
            return None
        held = [c for c in table.columns if c in view.dimensions]
        counted = {n for n in stored if kind_of(view.measures[n].expr)[0] == "distinct"}
        if not set(dims) <= set(held) or not stored <= set(table.columns):
            return None
        conditions = []
        for one in where:
            if isinstance(one, str):
                try:  # over the dimensions alone, so it means what it means on the source
                    table.select(*[F.col(f"`{c}`") for c in held]).filter(one)
                except AnalysisException:
                    return None
                conditions.append(F.expr(one))
            elif one[0] in held:
                conditions.append(COMPARE[one[1]](F.col(f"`{one[0]}`"), F.lit(one[2])))
            else:
                return None
        wanted = F.col(COUNTED).isNull()
        if counted:
            wanted = wanted | F.col(COUNTED).isin(sorted(counted))
        cells = table.filter(wanted)
        for condition in conditions:
            cells = cells.filter(condition)
        return cells

    def _answer(self, cells: DataFrame, dims: Sequence[str], measures: Sequence[str]) -> DataFrame:
        view = self.metrics.view
        stored = sorted(set().union(*[parts_of(view, name) for name in measures]))
        kinds = {name: kind_of(view.measures[name].expr)[0] for name in stored}
        keys = [f"`{d}`" for d in dims]

        def summed(name: str) -> Column:
            total = F.sum(f"`{name}`")
            return (F.coalesce(total, F.lit(0)) if kinds[name] == "count" else total).alias(name)

        sums = [n for n in stored if kinds[n] != "distinct"]
        counts = [n for n in stored if kinds[n] == "distinct"]
        if counts:
            # bitmaps of the same numbers are put together, then counted; a row has one of them
            cells = cells.groupBy(*keys, COUNTED, BUCKET).agg(
                F.bitmap_or_agg(F.coalesce(*[F.col(f"`{n}`") for n in counts])).alias("_bits"),
                *[F.sum(f"`{n}`").alias(n) for n in sums],
            )
        of = {n: F.when(F.col(COUNTED) == n, F.bitmap_count("_bits")) for n in counts}
        totals = cells.groupBy(*keys).agg(F.count("*").alias("_rows"), *[summed(n) for n in sums], *[
            F.coalesce(F.sum(c), F.lit(0)).alias(n) for n, c in of.items()
        ])
        return totals.select(*keys, *[F.expr(self._over(name)).alias(name) for name in measures])

    def _over(self, name: str) -> str:
        """A measure as an expression over the stored ones."""
        view = self.metrics.view
        if kind_of(view.measures[name].expr):
            return f"`{name}`"
        return NAMED.sub(
            lambda m: f"({self._over(m[1])})" if m[1] in view.measures else m[0],
            view.measures[name].expr,
        )
