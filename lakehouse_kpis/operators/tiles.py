"""Dashboard aggregates: one generic operator, filters that reach several datasets, facets."""

from __future__ import annotations

import functools
import operator
import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakehouse_kpis.functions.money import mean, ratio, zero_unless

@dataclass(frozen=True)
class Measured:
    """A measure: built when a tile is evaluated, as columns need a running session, the text in which
    its input columns are named, and whether its values for parts of the rows add up to that of all."""

    build: Callable[[], Column]
    uses: tuple[str, ...] = ()
    adds: bool = False

    def __call__(self) -> Column:
        return self.build()

    def inputs(self, columns: Sequence[str]) -> set[str]:
        named = set(re.findall(r"\w+", " ".join(self.uses)))
        return named & set(columns)


# A selection per column: a list of values, or a (low, high) pair, either end open as None.
Selection = Mapping[str, Any]


def rows() -> Measured:
    return Measured(lambda: F.count("*"), adds=True)


def total(column: str, sign: int = 1) -> Measured:
    return Measured(
        lambda: F.sum(F.col(column) * sign if sign != 1 else F.col(column)), (column,), adds=True
    )


def total_where(condition: str, column: str, sign: int = 1) -> Measured:
    """Sum over the rows that meet a condition; zero if none does."""
    return Measured(
        lambda: F.sum(zero_unless(F.expr(condition), F.col(column) * sign)), (condition, column),
        adds=True,
    )


def rows_where(condition: str) -> Measured:
    return Measured(lambda: F.count_if(F.expr(condition)), (condition,), adds=True)


def distinct(column: str) -> Measured:
    return Measured(lambda: F.count_distinct(F.col(column)), (column,))


def average(column: str) -> Measured:
    return Measured(lambda: mean(column), (column,))


def quotient(numerator: Measured, denominator: Measured) -> Measured:
    """Ratio of two totals, NULL when the denominator is zero."""
    return Measured(
        lambda: ratio(numerator(), denominator()), numerator.uses + denominator.uses
    )


@dataclass(frozen=True)
class Tile:
    """dims and measures over a dataset; without dims one row, without measures a listing."""

    dataset: str
    dims: Sequence[str] = ()
    measures: Mapping[str, Measured] = field(default_factory=dict)
    order_by: Sequence[str] = ()
    limit: int | None = None


def aggregate(tile: Tile, dataset: DataFrame) -> DataFrame:
    if tile.measures:
        measured = [make().alias(name) for name, make in tile.measures.items()]
        result = dataset.groupBy(*tile.dims).agg(*measured)
    else:
        result = dataset.select(*tile.dims)
    return ordered(tile, result)


def ordered(tile: Tile, result: DataFrame) -> DataFrame:
    if tile.order_by:
        result = result.orderBy(*[
            F.desc_nulls_last(name[1:]) if name.startswith("-") else F.asc(name)
            for name in tile.order_by
        ])
    return result if tile.limit is None else result.limit(tile.limit)


def chosen(column: str, wanted: Any) -> Column:
    """A list keeps its values (None keeps NULL), a (low, high) pair keeps the range."""
    col = F.col(column)
    if isinstance(wanted, tuple):
        ends = [col >= F.lit(wanted[0])] if wanted[0] is not None else []
        ends += [col <= F.lit(wanted[1])] if wanted[1] is not None else []
        return functools.reduce(operator.and_, ends, F.lit(True))
    kept = col.isin([v for v in wanted if v is not None])
    return kept | col.isNull() if None in wanted else kept


@dataclass(frozen=True)
class Filter:
    """A filter control: one column, the datasets it reaches."""

    column: str
    datasets: Sequence[str]
    is_range: bool = False


def predicates(filters: Sequence[Filter], dataset: str, selection: Selection) -> dict[str, Column]:
    """The conditions that the active selections put on a dataset."""
    return {
        f.column: chosen(f.column, selection[f.column])
        for f in filters if dataset in f.datasets and f.column in selection
    }


def filtered(
    filters: Sequence[Filter], dataset: str, df: DataFrame, selection: Selection
) -> DataFrame:
    """The dataset under the selections; a filter that does not name it leaves it alone."""
    for condition in predicates(filters, dataset, selection).values():
        df = df.filter(condition)
    return df


def facet(
    control: Filter, filters: Sequence[Filter], datasets: Mapping[str, DataFrame],
    selection: Selection,
) -> DataFrame:
    """Per dataset and option of a filter, how many rows the other selections leave.

    An option with no row left stays, with zero, so that it can be shown as empty. The
    control's own selection is not applied to it.
    """
    parts = []
    for name in control.datasets:
        others = predicates(filters, name, selection)
        others.pop(control.column, None)
        left = functools.reduce(operator.and_, others.values(), F.lit(True))
        parts.append(
            datasets[name].groupBy(F.col(control.column).cast("string").alias("option"))
            .agg(F.count_if(left).alias("associativity"))
            .select(F.lit(name).alias("dataset"), "option", "associativity")
        )
    return functools.reduce(DataFrame.unionByName, parts)


def together(tiles: Mapping[str, Tile], dataset: DataFrame) -> tuple[DataFrame, Callable]:
    """All tiles over one dataset from one pass: their groups as one frame, and a function that takes
    a frame with its rows and the name of a tile, and returns the tile.

    Every row counts once for each set of dimensions that some tile groups by. It carries only the
    inputs that the tiles of that set use, so a distinct count is worked out for its own set alone;
    rows are combined before they are shuffled. Where all measures add up, the rows are first put
    together by all dimensions at once, and those groups are copied to the sets and not the rows.
    Tiles without measures list rows and have no groups.
    """
    sets: dict[tuple[str, ...], dict[str, Tile]] = {}
    for name, tile in tiles.items():
        sets.setdefault(tuple(sorted(tile.dims)), {})[name] = tile
    dims = sorted({d for held in sets for d in held})
    measures: dict[str, Column] = {}  # by what they compute, so that tiles share them
    for own in sets.values():
        for tile in own.values():
            for make in tile.measures.values():
                measures.setdefault(str(make()), make())
    names = {text: f"_m{i}" for i, text in enumerate(measures)}
    values = [column.alias(names[text]) for text, column in measures.items()]
    source = dataset
    if len(sets) > 1 and all(m.adds for t in tiles.values() for m in t.measures.values()):
        source = dataset.groupBy(*dims).agg(*values)
        used = {
            held: {names[str(m())] for t in own.values() for m in t.measures.values()}
            for held, own in sets.items()
        }
        values = [F.sum(n).cast(source.schema[n].dataType).alias(n) for n in names.values()]
    else:
        used = {
            held: set().union(*[
                m.inputs(dataset.columns) for t in own.values() for m in t.measures.values()
            ]) for held, own in sets.items()
        }
    inputs = sorted(set().union(*used.values()))
    types = dict(source.dtypes)

    def value(column: str, wanted: bool) -> Column:
        return F.col(column) if wanted else F.lit(None).cast(types[column])

    rows = F.array(*[
        F.struct(
            F.lit(i).alias("_set"),
            *[value(d, d in held).alias(f"_by_{d}") for d in dims],
            *[value(c, c in used[held]).alias(c) for c in inputs],
        ) for i, held in enumerate(sets)
    ])
    groups = source.select(F.inline(rows)).groupBy("_set", *[f"_by_{d}" for d in dims]).agg(*values)

    def take(found: DataFrame, name: str) -> DataFrame:
        tile = tiles[name]
        at = list(sets).index(tuple(sorted(tile.dims)))
        result = found.filter(F.col("_set") == at).select(
            *[F.col(f"_by_{d}").alias(d) for d in tile.dims],
            *[F.col(names[str(make())]).alias(n) for n, make in tile.measures.items()],
        )
        if not tile.dims:  # one row, whether or not there are rows to aggregate
            none = dataset.limit(0).agg(*[make().alias(n) for n, make in tile.measures.items()])
            result = _or_none(result, none)
        return ordered(tile, result)

    return groups, take


def _or_none(result: DataFrame, none: DataFrame) -> DataFrame:
    """A result of at most one row, or else the one row of an aggregate over nothing."""
    both = result.withColumn("_place", F.lit(0)).unionByName(none.withColumn("_place", F.lit(1)))
    return both.orderBy("_place").limit(1).drop("_place")


def facets(
    filters: Sequence[Filter], name: str, dataset: DataFrame, selection: Selection
) -> DataFrame:
    """Options of all controls that reach a dataset, from one pass: control, option, associativity.

    Each row has a mask of the selections that it fails. It counts for a control if no other selection
    fails, so the same rows as in `facet` for each control.
    """
    conditions = predicates(filters, name, selection)
    bits = {column: 1 << i for i, column in enumerate(conditions)}
    mask = functools.reduce(operator.add, [
        F.when(condition, 0).otherwise(bits[column]) for column, condition in conditions.items()
    ], F.lit(0))
    controls = [f.column for f in filters if name in f.datasets]
    rows = F.array(*[
        F.struct(
            F.lit(c).alias("control"), F.col(c).cast("string").alias("option"),
            (F.col("_mask").bitwiseAND(~bits.get(c, 0)) == 0).alias("_left"),
        ) for c in controls
    ])
    return dataset.withColumn("_mask", mask).select(F.inline(rows)).groupBy("control", "option").agg(
        F.count_if("_left").alias("associativity")
    )
