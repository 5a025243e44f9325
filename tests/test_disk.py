"""What is shuffled and written: source joins once a rollup, no shuffle files after a write."""

import time

import pytest
from conftest import first_plan, listed
from pyspark.sql import functions as F

from lakehouse_kpis.operators.metrics import MetricView
from lakehouse_kpis.operators.rollups import Rollups, _arguments, rollup
from lakehouse_kpis.session import DROPPED, shuffles_dropped, written

VIEW = {
    "source": "lines",
    "dimensions": [{"name": "Kind", "expr": "source.kind"}],
    "measures": [{"name": "Orders", "expr": "count(DISTINCT source.id)"},
                 {"name": "Buyers", "expr": "count(DISTINCT source.who)"},
                 {"name": "Both", "expr": "count(source.who, coalesce(source.u, nullif(source.w, ',')))"},
                 {"name": "Known", "expr": "count(source.v)"}, {"name": "Lines", "expr": "count(*)"},
                 {"name": "Twice", "expr": "sum(source.v * 2)"}],
}


def test_the_rows_of_a_rollup_are_made_once(spark):
    lines = spark.createDataFrame(
        [("k", "a", "x", 1, None, "1"), ("k", "a", None, 2, "w", None), ("k", "b", "x", None, ",", None),
         (None, None, "y", None, "w", None), ("l", "c", "y", 5, None, None), ("l", None, None, None, None, None)],
        "kind string, id string, who string, v int, w string, u string",
    )
    metrics = MetricView.from_dict(VIEW).bind({"lines": written(lines, "lines")})
    names = [m["name"] for m in VIEW["measures"]]
    made = rollup(metrics, ["Kind"], names)
    assert "/lines-" not in first_plan(made)
    rolled = Rollups(metrics, [written(made, "rollup")])
    for dims in ([], ["Kind"]):
        assert listed(rolled.query(dims, names)) == listed(metrics.query(dims, names))


def test_arguments_of_a_count():
    assert _arguments("a, coalesce(b, ','), ',x'") == ["a", " coalesce(b, ',')", " ',x'"]
    assert _arguments("`a,b`") == ["`a,b`"] and _arguments("*") == ["*"]


def test_a_write_leaves_no_shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def left() -> set:
        return {f for f in disk.getAllFiles().mkString("\n").split("\n") if "shuffle_" in f}

    before = left()
    frame = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    assert written(frame, "counts").count() == 7
    made = spark.conf.get(DROPPED)
    end = time.time() + 20
    while (new := [f for f in left() - before if "shuffle_" in f]) and len(new) > 2 and time.time() < end:
        time.sleep(0.2)
    # the count above is a query of its own, with one shuffle of its own: an index and a data file a task
    names = {f.split("shuffle_")[1].split("_")[0] for f in new}
    assert len(names) <= 1
    with pytest.raises(ZeroDivisionError), shuffles_dropped(spark):
        assert spark.conf.get(DROPPED) == "true"
        1 / 0
    assert spark.conf.get(DROPPED) == made
