import datetime as dt

import pytest
from conftest import listed

from lakehouse_kpis.operators.tiles import (
    Filter, Tile, aggregate, average, distinct, facet, facets, filtered, quotient, rows,
    rows_where, together, total, total_where,
)
from lakehouse_kpis.plans import dashboards

FILTERS = [Filter("place", ("sales", "deals")), Filter("kind", ("sales",)),
           Filter("day", ("sales",), is_range=True)]


@pytest.fixture(scope="module")
def data(spark):
    day = dt.date(2024, 1, 1)
    sales = [("E", "x", day, 1.0), ("E", "y", day, 2.0), ("W", "x", day, 4.0),
             (None, "x", dt.date(2024, 2, 1), 8.0)]
    deals = [("E", 10.0), ("W", 20.0), (None, 40.0)]
    return {
        "sales": spark.createDataFrame(sales, "place string, kind string, day date, v double"),
        "deals": spark.createDataFrame(deals, "place string, v double"),
    }


def test_counters(data):
    tile = Tile("sales", measures={
        "t": total("v"), "n": rows(), "d": distinct("place"), "a": average("v"),
        "x": total_where("kind = 'y'", "v"), "none": total_where("kind = 'z'", "v"),
        "r": quotient(rows_where("kind = 'x'"), rows()),
        "zero": quotient(rows(), rows_where("kind = 'z'"))})
    row = aggregate(tile, data["sales"]).first().asDict()
    assert {k: None if v is None else float(v) for k, v in row.items()} == {
        "t": 15.0, "n": 4, "d": 2, "a": 3.75, "x": 2.0, "none": 0.0, "r": 0.75, "zero": None}


def test_ordered_top_k_with_ties(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", 2), ("d", None)], "k string, v int")
    tile = Tile("t", ("k",), {"s": total("v")}, order_by=("-s", "k"), limit=3)
    assert [tuple(r) for r in aggregate(tile, df).collect()] == [("c", 2), ("a", 1), ("b", 1)]


def test_listing(data):
    tile = Tile("deals", ("place", "v"), order_by=("-v",))
    assert [r.v for r in aggregate(tile, data["deals"]).collect()] == [40.0, 20.0, 10.0]


@pytest.mark.parametrize("selection, sales, deals", [
    ({}, 15.0, 70.0),
    ({"place": ["E"]}, 3.0, 10.0),
    ({"place": ["E", None]}, 11.0, 50.0),
    ({"kind": ["x"]}, 13.0, 70.0),
    ({"kind": ["x"], "place": ["E"]}, 1.0, 10.0),
    ({"day": (dt.date(2024, 1, 15), None)}, 8.0, 70.0),
    ({"day": (None, dt.date(2024, 1, 1))}, 7.0, 70.0),
    ({"place": []}, None, None),
])
def test_cross_filters(data, selection, sales, deals):
    tile = Tile("", measures={"t": total("v")})
    for name, expected in (("sales", sales), ("deals", deals)):
        got = aggregate(tile, filtered(FILTERS, name, data[name], selection))
        assert got.first()[0] == expected


def test_facets(data):
    selection = {"place": ["E"], "kind": ["x"]}
    got = set(listed(facet(FILTERS[0], FILTERS, data, selection)))
    # the control's own selection does not count, the other one does where it applies
    assert got == {("sales", "E", 1), ("sales", "W", 1), ("sales", None, 1),
                   ("deals", "E", 1), ("deals", "W", 1), ("deals", None, 1)}
    kinds = set(listed(facet(FILTERS[1], FILTERS, data, {"place": ["W"]})))
    assert kinds == {("sales", "x", 1), ("sales", "y", 0)}


def test_inventory():
    tiles = [t for p in dashboards.PAGES.values() for t in p.tiles]
    filters = [f for p in dashboards.PAGES.values() for f in p.filters]
    assert len(tiles) == 54 and len(filters) == 23
    assert sum(f.is_range for f in filters) == 4


def test_counters_sum_to_the_page(lake):
    whole = dashboards.tile(lake, "executive", "net_revenue").first()[0]
    parts = dashboards.tile(lake, "executive", "revenue_by_month_system").collect()
    assert abs(sum(r.net_revenue for r in parts) - whole) < 0.01


@pytest.mark.parametrize("selected", [False, True])
@pytest.mark.parametrize("page", list(dashboards.PAGES))
def test_a_page_equals_its_tiles(lake, page, selected):
    selection = dashboards.PAGES[page].example if selected else None
    found = dashboards.page(lake, page, selection)
    assert list(found) == list(dashboards.PAGES[page].tiles)
    for name, frame in found.items():
        alone = dashboards.tile(lake, page, name, selection)
        assert frame.columns == alone.columns
        assert listed(frame) == listed(alone), name


@pytest.mark.parametrize("page", list(dashboards.PAGES))
def test_all_facets_in_one_pass(lake, page):
    selection = dashboards.PAGES[page].example
    together_ = {}
    for r in dashboards.page_options(lake, page, selection).collect():
        together_.setdefault(r.control, set()).add((r.dataset, r.option, r.associativity))
    for f in dashboards.PAGES[page].filters:
        assert together_[f.column] == set(map(tuple, dashboards.options(
            lake, page, f.column, selection).collect())), f.column


def test_one_pass_per_dataset(data):
    """The rows are read once for all tiles, and once for all controls."""
    tiles = {
        "t": Tile("sales", measures={"t": total("v")}),
        "d": Tile("sales", ("place",), {"d": distinct("kind")}),
        "n": Tile("sales", ("kind", "place"), {"n": rows(), "a": average("v")}),
    }
    groups, take = together(tiles, data["sales"])
    plan = groups._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1
    for name, tile in tiles.items():
        assert listed(take(groups, name)) == listed(aggregate(tile, data["sales"]))
    none = data["sales"].limit(0)
    groups, take = together(tiles, none)
    assert listed(take(groups, "t")) == [(None,)] and listed(take(groups, "n")) == []
    plan = facets(FILTERS, "sales", data["sales"], {"place": ["E"], "kind": ["x"]})
    assert plan._jdf.queryExecution().executedPlan().toString().count("Scan") == 1


def test_rows_are_put_together_before_they_are_copied_to_the_tiles(data):
    """Where all measures add up, the copies for the sets of dimensions are made of groups."""
    tiles = {
        "t": Tile("sales", measures={"t": total("v"), "x": total_where("kind = 'x'", "v", -1)}),
        "k": Tile("sales", ("kind",), {"n": rows(), "e": rows_where("place = 'E'")}),
        "p": Tile("sales", ("place", "kind"), {"t": total("v")}),
    }
    twice = data["sales"].union(data["sales"])
    groups, take = together(tiles, twice)
    plan = groups._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" in plan[plan.index("Generate"):]
    for name, tile in tiles.items():
        expected = aggregate(tile, twice)
        assert listed(take(groups, name)) == listed(expected)
        assert take(groups, name).dtypes == expected.dtypes
    groups, take = together(tiles, twice.limit(0))
    assert listed(take(groups, "t")) == [(None, None)] and listed(take(groups, "k")) == []
