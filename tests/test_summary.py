"""The sales summary: what its shuffle by invoice carries, and odd rows."""

from conftest import first_plan
from pyspark.sql import functions as F

from lakehouse_kpis.operators import gold


def test_summary_shuffles_no_sums_with_the_invoices(spark):
    fact = spark.createDataFrame([
        ("i1", "c1", "p1", "2024-01-03", 2, 10.0), ("i1", "c1", "p2", "2024-01-03", 1, None),
        ("i2", "c1", "p1", "2024-01-09", None, 1.5), (None, "c1", "p1", "2024-01-09", 3, 2.0),
        ("i3", "c2", "p1", None, 1, 4.0), ("i4", "c9", "p1", "2024-01-03", 1, 7.0),
        (None, "c3", "p1", "2024-02-03", 1, None),
    ], "invoice_id string, customer_key string, product_key string, d string, quantity int, v double").select(
        "invoice_id", "customer_key", "product_key", F.col("d").cast("date").alias("invoice_date"), "quantity",
        *[F.col("v").cast("decimal(18,2)").alias(n) for n in (
            "gross_line_amount", "discount_amount", "freight_amount", "pallet_amount", "net_invoice_amount")],
        F.lit("S").alias("source_system"),
    )
    customer = spark.createDataFrame([("c1", "T", "A"), ("c1", "T", "A"), ("c2", None, "B"), ("c3", "U", None)],
                                     "customer_key string, territory string, customer_segment string")
    product = spark.createDataFrame([("p1", "L", "X", 1.0), ("p2", "L", "X", 2.0)],
                                    "product_key string, product_line string, product_tier string, u double").select(
        "product_key", "product_line", "product_tier", F.col("u").cast("decimal(22,6)").alias("unit_cost_usd"))
    rows = gold.sales_summary(fact, customer, product)
    amount = "(net_invoice_amount#"
    assert not [line for line in first_plan(rows).splitlines() if f"partial_sum{amount}" in line]
    found = {(str(r[0]), r[1], r[2]): tuple(None if v is None else float(v) for v in r[6:]) for r in rows.collect()}
    # count of invoices, lines, units, gross, discount, charges, net, cost and margin
    assert found == {
        ("2024-01-01", "T", "A"): (2.0, 8.0, 12.0, 27.0, 27.0, 54.0, 27.0, 14.0, 13.0),
        ("None", None, "B"): (1.0, 1.0, 1.0, 4.0, 4.0, 8.0, 4.0, 1.0, 3.0),
        ("2024-02-01", "U", None): (0.0, 1.0, 1.0, None, None, None, None, 1.0, None),
    }
