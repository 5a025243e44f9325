"""Stored rollups: what they answer equals the metric view's own answer."""

import datetime as dt

import pytest
from conftest import first_plan, listed
from pyspark.sql import functions as F

from lakehouse_kpis.operators.metrics import MetricView
from lakehouse_kpis.operators.rollups import Rollups, kind_of, parts_of, rollup
from lakehouse_kpis.plans.sales_metrics import SALES_METRICS
from lakehouse_kpis.session import written

VIEW = MetricView.from_dict({
    "source": "lines",
    "joins": [{"name": "who", "source": "who", "on": "source.who = who.who"}],
    "dimensions": [{"name": "Day", "expr": "source.day"}, {"name": "Area", "expr": "who.area"},
                   {"name": "Kind", "expr": "source.kind"}],
    "measures": [{"name": "Orders", "expr": "count(DISTINCT source.id)"},
                 {"name": "Buyers", "expr": "count(DISTINCT source.who)"},
                 {"name": "Lines", "expr": "count(*)"}, {"name": "Known", "expr": "count(source.v)"},
                 {"name": "Total", "expr": "sum(source.v)"},
                 {"name": "Each", "expr": "if(`Orders` = 0, 0D, double(`Total`) / double(`Orders`))"},
                 {"name": "Largest", "expr": "max(source.v)"}],
})
ROLLED = ["Orders", "Buyers", "Lines", "Known", "Total", "Each"]


@pytest.fixture(scope="module")
def metrics(spark):
    # an order over several days, kinds and buyers; nulls in every column; 70,000 ids need three bitmaps
    many = spark.range(70_000).select(
        F.concat(F.lit("o"), F.col("id") % 69_000).alias("id"), (F.col("id") % 11).cast("string").alias("who"),
        F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 3).cast("int")).alias("day"),
        F.when(F.col("id") % 5 > 0, (F.col("id") % 5).cast("string")).alias("kind"),
        (F.col("id") % 7).cast("decimal(18,2)").alias("v"))
    odd = spark.createDataFrame(
        [(None, None, None, None, None), ("o1", None, dt.date(2024, 1, 2), "k", 1.0),
         ("o1", "1", dt.date(2024, 1, 9), None, None)],
        "id string, who string, day date, kind string, v double",
    ).withColumn("v", F.col("v").cast("decimal(18,2)"))
    who = spark.range(8).select(F.col("id").cast("string").alias("who"),
                                F.concat(F.lit("a"), F.col("id") % 3).alias("area"))
    return VIEW.bind({"lines": written(many.unionByName(odd), "lines"), "who": who})


@pytest.fixture(scope="module")
def rollups(metrics):
    small = written(rollup(metrics, ["Area"], ["Lines", "Total"]), "small")
    large = written(rollup(metrics, ["Day", "Area", "Kind"], ROLLED, near="source.day"), "large")
    return Rollups(metrics, [small, large])


def scanned(df) -> str:
    return first_plan(df)


@pytest.mark.parametrize("dims", [[], ["Area"], ["Day"], ["Kind", "Area"], ["Day", "Area", "Kind"]])
@pytest.mark.parametrize("where", [
    [], [("Kind", "=", "3")], ["`Area` IS NULL OR `Kind` > '2'", ("Day", "<", dt.date(2024, 1, 3))],
    [("Kind", "=", "none such")],
])
def test_equal_to_the_view(metrics, rollups, dims, where):
    got, want = (m.query(dims, ROLLED, where) for m in (rollups, metrics))
    assert got.schema == want.schema or [f.name for f in got.schema] == [f.name for f in want.schema]
    assert listed(got) == listed(want)
    assert "/lines-" in scanned(want) and "/lines-" not in scanned(got)


def test_the_smallest_that_can(rollups):
    assert "/small-" in scanned(rollups.query(["Area"], ["Total"]))
    assert "/large-" in scanned(rollups.query(["Area"], ["Orders"]))   # not in the small one
    assert "/large-" in scanned(rollups.query(["Area"], ["Total"], [("Kind", "=", "1")]))
    # a measure that does not roll up, and a condition on more than dimensions
    assert "/lines-" in scanned(rollups.query(["Area"], ["Largest"]))
    assert "/lines-" in scanned(rollups.query(["Area"], ["Total"], ["source.v > 3"]))
    with pytest.raises(KeyError):
        rollups.query(["No Such"], ["Total"])


def test_no_line_is_read_twice_for_distinct_counts(rollups):
    assert "Expand" not in scanned(rollups.query(["Area"], ["Orders", "Buyers"]))


def test_order_and_limit(metrics, rollups):
    ask = (["Kind"], ["Orders", "Total"], [], "`Orders` > 5", ["-Total", "Kind"], 2)
    assert rollups.query(*ask).collect() == metrics.query(*ask).collect()


def test_kinds_of_measures():
    assert kind_of("sum(a.b + (c))") == ("sum", "a.b + (c)")
    assert kind_of("count( DISTINCT x)") == ("distinct", "x") and kind_of("COUNT(*)") == ("count", "*")
    for no in ("sum(a) - sum(b)", "max(a)", "sum(a) / count(*)", "avg(x)", "sum(DISTINCT x)"):
        assert kind_of(no) is None
    assert parts_of(SALES_METRICS, "Gross Margin Pct") == {"Net Revenue", "Estimated COGS"}
    with pytest.raises(ValueError):
        parts_of(VIEW, "Largest")
