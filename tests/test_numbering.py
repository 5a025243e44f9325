import pytest
from conftest import final_plan
from pyspark.sql import functions as F

from lakehouse_kpis.operators.numbering import numbered, running


def test_numbers_equal_a_window_over_all(spark):
    rows = spark.range(5000).select(
        (F.col("id") * 7919 % 5003).alias("k"), F.lit("x").alias("v"), (F.col("id") % 3).alias("at")
    ).repartition(7)
    found = {r["k"]: r["n"] for r in numbered(rows, ["k"], "n").collect()}
    assert found == {k: i for i, k in enumerate(sorted(found), 1)} and len(found) == 5000
    tied = numbered(rows, [-F.col("at"), "k"], "n", 0).collect()
    want = sorted(((-r["at"], r["k"]) for r in tied))
    assert [(-r["at"], r["k"]) for r in sorted(tied, key=lambda r: r["n"])] == want
    assert numbered(rows.limit(0), ["k"], "n").count() == 0
    with pytest.raises(ValueError):
        numbered(rows, ["k"], "v")


def test_no_task_sees_the_whole_table(spark):
    df = numbered(spark.range(3000).withColumn("x", F.rand(1)), ["id"], "n")
    windows = [line for line in final_plan(df).splitlines() if " Window [" in line]
    # functions, partition and order: a window over all rows has no partition
    assert windows and all(line.count("], [") >= 2 for line in windows)
    sizes = spark.range(10_000).select(F.col("id").alias("p"), (F.col("id") % 5).alias("n"))
    want, before = {}, 0
    for p in range(10_000):
        want[p], before = before, before + p % 5
    assert {r["p"]: r["before"] for r in running(sizes, "p", "n").collect()} == want
