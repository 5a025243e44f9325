import dataclasses
import datetime as dt

import pytest
from conftest import first_plan, listed
from pyspark.errors import PySparkException

from lakehouse_kpis.operators.metrics import MetricView
from lakehouse_kpis.plans.sales_metrics import SALES_METRICS, sales_metrics

FACT = ("invoice_id string, invoice_date date, customer_key string, product_key string,"
        " quantity int, gross_line_amount double, freight_amount double, discount_amount double,"
        " pallet_amount double, net_invoice_amount double, source_system string")
JAN, FEB, OLD = dt.date(2024, 1, 31), dt.date(2024, 2, 1), dt.date(2018, 12, 31)


def tables(spark, products=(("P1", "Slabs", "Core", 2.0),)):
    fact = [
        ("I1", JAN, "C1", "P1", 2, 10.0, 1.0, -1.0, 0.0, 10.0, "S"),
        ("I1", FEB, "C2", "P9", 3, 20.0, 0.0, 0.0, 0.0, 20.0, "S"),  # no such product
        ("I2", FEB, None, "P1", 1, 5.0, 0.0, -5.0, 0.0, 0.0, "S"),   # no customer
        ("I3", OLD, "C1", "P1", 9, 99.0, 0.0, 0.0, 0.0, 99.0, "S"),  # before the filter
    ]
    customers = [("C1", "US-East", "US", "HOMEOWNER"), ("C2", None, None, "CONTRACTOR")]
    return {
        "fact_invoice_lines": spark.createDataFrame(fact, FACT),
        "dim_customer": spark.createDataFrame(
            customers, "customer_key string, territory string, country string,"
                       " customer_segment string"),
        "dim_product": spark.createDataFrame(
            list(products), "product_key string, product_line string, product_tier string,"
                            " unit_cost_usd double"),
    }


@pytest.fixture(scope="module")
def sales(spark):
    return SALES_METRICS.bind(tables(spark))


def test_inventory():
    assert len(SALES_METRICS.dimensions) == 9 and len(SALES_METRICS.measures) == 13


def test_grand_total(sales):
    names = list(SALES_METRICS.measures)
    row = sales.query([], names).first().asDict()
    assert row == {
        "Invoice Count": 2, "Line Count": 3, "Units Sold": 6, "Gross Revenue": 35.0,
        "Discounts": -6.0, "Freight & Pallet": 1.0, "Net Revenue": 30.0,
        "Estimated COGS": 6.0, "Estimated Gross Margin": 24.0, "Gross Margin Pct": 24 / 30,
        "Discount Pct": 6 / 35, "Average Invoice Value": 15.0, "Active Customers": 2}


def test_facts_without_dimension_row_stay(sales):
    got = sales.query(["Product Line"], ["Net Revenue", "Estimated COGS"])
    assert set(listed(got)) == {("Slabs", 10.0, 6.0), (None, 20.0, None)}


def test_zero_denominators(sales):
    got = sales.query(["Customer Segment"], ["Gross Margin Pct", "Discount Pct"],
                      where=["`Customer Segment` IS NULL"])
    assert listed(got) == [(None, 0.0, 1.0)]


def test_no_rows(sales):
    got = sales.query([], ["Net Revenue", "Invoice Count", "Average Invoice Value"],
                      where=["`Territory` = 'nowhere'"])
    assert listed(got) == [(None, 0, 0.0)]


def test_distinct_counts_are_not_additive(sales):
    by_month = listed(sales.query(["Invoice Month"], ["Invoice Count"]))
    assert by_month == [(dt.date(2024, 1, 1), 1), (dt.date(2024, 2, 1), 2)]
    assert sales.query([], ["Invoice Count"]).first()[0] == 2


@pytest.mark.parametrize("op, value, months", [
    (">=", dt.date(2024, 2, 1), [2]), (">", dt.date(2024, 1, 1), [2]),
    ("<", dt.date(2024, 2, 1), [1]), ("<=", dt.date(2024, 1, 1), [1]),
    ("=", dt.date(2024, 1, 1), [1]), ("<>", dt.date(2024, 1, 1), [2]),
    (">=", dt.date(2024, 1, 15), [2]),  # not a month start: compared as it is
])
def test_month_filters(sales, op, value, months):
    got = sales.query(["Invoice Month"], ["Line Count"], where=[("Invoice Month", op, value)])
    assert sorted(r[0].month for r in got.collect()) == months


def test_year_filter_and_having_and_limit(sales):
    assert sales.query([], ["Line Count"], where=[("Invoice Year", "=", 2024)]).first()[0] == 3
    got = sales.query(["Invoice Month"], ["Net Revenue"], having="`Net Revenue` > 15")
    assert listed(got) == [(dt.date(2024, 2, 1), 20.0)]
    top = sales.query(["Invoice Month"], ["Net Revenue"], order_by=["-Net Revenue"], limit=1)
    assert top.first()[1] == 20.0


def test_only_needed_joins_are_made(sales):
    def joins(*args, **kw):
        return first_plan(sales.query(*args, **kw)).count("Join")

    assert joins(["Source System"], ["Net Revenue"]) == 0
    assert joins(["Territory"], ["Net Revenue"]) == 1
    assert joins(["Territory"], ["Estimated COGS"]) == 2
    assert joins([], ["Line Count"], where=["`Product Tier` = 'Core'"]) == 1


def test_duplicate_key_stops_the_query(spark):
    twice = [("P1", "Slabs", "Core", 2.0), ("P1", "Pavers", "Core", 3.0)]
    sales = SALES_METRICS.bind(tables(spark, twice))
    with pytest.raises(PySparkException, match="not unique"):
        sales.query(["Product Line"], ["Net Revenue"]).collect()
    # a query that does not need the join is not concerned
    assert sales.query([], ["Line Count"]).first()[0] == 3


def test_duplicate_key_first(spark):
    spec = {
        "source": "fact_invoice_lines",
        "joins": [{"name": "product", "source": "dim_product", "on_duplicate": "first",
                   "on": "source.product_key = product.product_key",
                   "order": ["-unit_cost_usd"]}],
        "dimensions": [{"name": "Line", "expr": "product.product_line"}],
        "measures": [{"name": "Lines", "expr": "count(*)"}],
    }
    twice = [("P1", "Slabs", "Core", 2.0), ("P1", "Pavers", "Core", 3.0)]
    view = MetricView.from_dict(spec).bind(tables(spark, twice))
    got = dict(listed(view.query(["Line"], ["Lines"])))
    assert got == {"Pavers": 3, None: 1}


def test_null_keys_in_a_dimension_are_no_duplicates(spark):
    rows = [("P1", "Slabs", "Core", 2.0), (None, "x", "y", 1.0), (None, "x", "y", 1.0)]
    sales = SALES_METRICS.bind(tables(spark, rows))
    assert sales.query(["Product Line"], ["Line Count"]).count() == 2


def test_errors(sales):
    with pytest.raises(KeyError):
        sales.query(["No Such"], ["Net Revenue"])
    with pytest.raises(KeyError):
        sales.query([], ["No Such"])
    loop = MetricView.from_dict({"source": "fact_invoice_lines", "measures": [
        {"name": "A", "expr": "`B` + 1"}, {"name": "B", "expr": "`A` + 1"}]})
    with pytest.raises(ValueError):
        loop.bind(sales.tables).query([], ["A"])


def test_yaml(sales):
    pytest.importorskip("yaml")
    view = MetricView.from_yaml("""
version: 0.1
source: fact_invoice_lines
filter: invoice_date >= '2019-01-01'
joins:
  - name: customer
    source: dim_customer
    'on': source.customer_key = customer.customer_key
dimensions:
  - name: Segment
    expr: customer.customer_segment
measures:
  - name: Revenue
    expr: SUM(source.net_invoice_amount)
""")
    got = view.bind(sales.tables).query(["Segment"], ["Revenue"])
    assert dict(listed(got)) == {"HOMEOWNER": 10.0, "CONTRACTOR": 20.0, None: 0.0}


def test_approximate_counts(sales):
    exact = sales.query([], ["Invoice Count", "Active Customers"]).first()
    close = sales.query([], ["Invoice Count", "Active Customers"], approximate=True)
    assert "approx_count_distinct" in first_plan(close) and tuple(close.first()) == tuple(exact)


def test_additive_measures_agree_across_grains(lake):
    names = ["Line Count", "Units Sold", "Net Revenue"]
    total = lake.metrics.query([], names).first()
    for dims in (["Territory"], ["Invoice Month", "Product Line"]):
        parts = lake.metrics.query(dims, names).collect()
        assert sum(p["Line Count"] for p in parts) == total["Line Count"]
        assert sum(p["Units Sold"] for p in parts) == total["Units Sold"]
        assert abs(sum(p["Net Revenue"] for p in parts) - total["Net Revenue"]) < 0.01


def test_history_start(spark):
    every = sales_metrics(None).bind(tables(spark))
    assert every.query([], ["Line Count"]).first()[0] == 4


def test_trusted_keys_are_not_checked(spark):
    spec = {
        "source": "fact_invoice_lines",
        "joins": [{"name": "product", "source": "dim_product", "on_duplicate": "trust",
                   "on": "source.product_key = product.product_key"}],
        "dimensions": [{"name": "Line", "expr": "product.product_line"}],
        "measures": [{"name": "Lines", "expr": "count(*)"}],
    }
    view = MetricView.from_dict(spec).bind(tables(spark))
    query = view.query(["Line"], ["Lines"])
    assert "ubquery" not in first_plan(query) and query.count() == 2
    spec["joins"][0]["on_duplicate"] = "whatever"
    with pytest.raises(ValueError):
        MetricView.from_dict(spec)


def test_keys_verified_once(spark):
    good = SALES_METRICS.verified(tables(spark))
    assert [j.on_duplicate for j in good.joins] == ["trust", "trust"]
    twice = tables(spark, [("P1", "Slabs", "Core", 2.0), ("P1", "Pavers", "Core", 3.0)])
    half = SALES_METRICS.verified(twice)
    assert [j.on_duplicate for j in half.joins] == ["trust", "error"]
    with pytest.raises(PySparkException, match="not unique"):
        half.bind(twice).query(["Product Line"], ["Net Revenue"]).collect()


def test_literals_and_quoted_aliases_in_conditions(spark):
    """A literal that holds a dimension's name stays as it is; `alias`.column needs its join."""
    rows = tables(spark)
    odd = [("C1", "see `Territory`", "US", "HOMEOWNER"), ("C2", None, None, "CONTRACTOR")]
    rows["dim_customer"] = spark.createDataFrame(odd, rows["dim_customer"].schema)
    bound = SALES_METRICS.bind(rows)
    by_text = bound.query([], ["Line Count"], where=["`Territory` = 'see `Territory`'"])
    by_tuple = bound.query([], ["Line Count"], where=[("Territory", "=", "see `Territory`")])
    assert listed(by_text) == listed(by_tuple) == [(1,)]
    quoted = bound.query([], ["Line Count"], where=["`customer`.country = 'US'"])
    assert listed(quoted) == [(1,)]


def test_view_filter_on_a_joined_column(spark):
    view = dataclasses.replace(SALES_METRICS, filter="customer.customer_segment = 'CONTRACTOR'")
    assert listed(view.bind(tables(spark)).query([], ["Line Count"])) == [(1,)]
