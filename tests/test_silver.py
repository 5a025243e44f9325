import datetime as dt
import decimal

import pytest
from conftest import final_plan, listed
from pyspark.sql import functions as F

from lakehouse_kpis.functions.money import price
from lakehouse_kpis.operators import dims, facts
from lakehouse_kpis.sources.shapes import SHAPES

D = dt.date(2024, 1, 1)
LINE = ("INVOICEID string, LINENUM int, INVOICEACCOUNT string, ITEMID string, INVOICEDATE date,"
        " QTY int, SALESPRICE double, LINEAMOUNT double, TAXAMOUNT double, CURRENCYCODE string")
HEADER = ("INVOICEID string, INVOICEACCOUNT string, INVOICEDATE date, INVOICEAMOUNT double,"
          " SALESTAXAMOUNT double, CURRENCYCODE string")
CHARGE = "INVOICEID string, MARKUPCODE string, VALUE double"


def line(invoice, number, amount):
    return (invoice, number, "C1", f"P{number}", D, 1, amount, amount, 0.0, "USD")


@pytest.fixture(scope="module")
def landed(spark):
    lines = [line("A", 1, 10.0), line("A", 2, 20.0), line("A", 3, 30.0), line("B", 1, 5.0),
             line("C", 1, 7.0)]
    charges = [("A", "FREIGHT", 3.0), ("A", "DISCOUNT", -1.0), ("A", "PALLET", 45.0),
               ("A", "FREIGHT", 0.5), ("B", "DISCOUNT", -2.0), ("B", "UNKNOWN", 99.0),
               ("GONE", "FREIGHT", 1.0)]
    headers = [("L", "C2", D, 100.0, 8.0, "USD")]
    return (spark.createDataFrame(lines, LINE), spark.createDataFrame(charges, CHARGE),
            spark.createDataFrame(headers, HEADER))


def test_repeated_charges(landed):
    fact = facts.fact_invoice_lines(*landed)
    got = {(r.invoice_id, r.line_num): tuple(map(float, (
        r.freight_amount, r.discount_amount, r.pallet_amount, r.net_invoice_amount)))
        for r in fact.collect()}
    assert got == {
        ("A", 1): (3.5, -1.0, 45.0, 57.5), ("A", 2): (3.5, -1.0, 45.0, 67.5),
        ("A", 3): (3.5, -1.0, 45.0, 77.5), ("B", 1): (0.0, -2.0, 0.0, 3.0),
        ("C", 1): (0.0, 0.0, 0.0, 7.0), ("L", 1): (0.0, 0.0, 0.0, 100.0)}


def test_slots_change_nothing(landed):
    columns = ["invoice_id", "line_num", "net_invoice_amount"]
    plain = listed(facts.fact_invoice_lines(*landed, spread=1), *columns)
    for spread in (2, 7):
        assert listed(facts.fact_invoice_lines(*landed, spread=spread), *columns) == plain


def test_equal_allocation_keeps_the_total(landed):
    fact = facts.fact_invoice_lines(*landed, allocation="equal")
    charged = fact.filter("invoice_id = 'A'").agg(
        F.sum(F.col("freight_amount") + F.col("discount_amount") + F.col("pallet_amount")),
        F.sum(F.col("net_invoice_amount") - F.col("gross_line_amount")),
    ).first()
    assert set(charged) == {decimal.Decimal("47.5")}
    with pytest.raises(ValueError):
        facts.fact_invoice_lines(*landed, allocation="some")


def test_odd_cents_go_to_the_first_lines(spark, landed):
    numbers = [5, 100_001, 200_000, 7, 300_000, 5]  # in several blocks, and one number twice
    lines = landed[0].limit(1).drop("LINENUM", "INVOICEID").crossJoin(
        spark.createDataFrame([("X", n) for n in numbers], "INVOICEID string, LINENUM int"))
    charges = spark.createDataFrame([
        ("X", "FREIGHT", 100.0), ("X", "DISCOUNT", -0.05), ("X", "PALLET", 0.06)],
        "INVOICEID string, MARKUPCODE string, VALUE double")
    fact = facts.fact_invoice_lines(lines, charges, landed[2].limit(0), allocation="equal")
    parts = listed(fact, "line_num", *facts.CHARGES)
    at = {n: [tuple(map(float, p[1:])) for p in parts if p[0] == n] for n in numbers}
    assert sorted(at[5]) == [(16.67, -0.01, 0.01)] * 2
    assert at[7] == at[100_001] == [(16.67, -0.01, 0.01)]
    assert at[200_000] == [(16.66, -0.01, 0.01)] and at[300_000] == [(16.66, 0.0, 0.01)]


def test_unit_prices_keep_parts_of_a_cent(spark):
    row = spark.createDataFrame([(0.0049, 1.2345)], "UNITCOST_USD double, LISTPRICE_USD double")
    kinds = {c: SHAPES["products"][c] for c in row.columns}
    got = row.select(*[price(F.col(c).cast(t)) for c, t in kinds.items()]).first()
    assert tuple(map(float, got)) == (0.0049, 1.2345)


def test_header_becomes_one_line(landed):
    row = facts.header_as_line(landed[2]).first()
    assert (row.line_num, row.quantity, float(row.unit_sales_price)) == (1, 1, 100.0)
    assert row.source_system == "AX_2012" and row.product_key.startswith("ITM")
    assert 1 <= int(row.product_key[3:]) <= 192


def test_a_huge_invoice_is_split(spark, landed):
    """A third of all lines on one invoice: the join spreads them over several tasks."""
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("I"), F.col("id")))
        .alias("INVOICEID"),
        F.col("id").cast("int").alias("LINENUM"), F.lit("C1").alias("INVOICEACCOUNT"),
        F.lit("P1").alias("ITEMID"), F.lit(D).alias("INVOICEDATE"), F.lit(1).alias("QTY"),
        F.lit(1.0).alias("SALESPRICE"), F.lit(1.0).alias("LINEAMOUNT"),
        F.lit(0.0).alias("TAXAMOUNT"), F.lit("USD").alias("CURRENCYCODE"),
    )
    charges = spark.createDataFrame([("HOT", "FREIGHT", 2.0)], CHARGE)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        fact = facts.fact_invoice_lines(rows, charges, landed[2], spread=4)
        per_task = fact.filter("invoice_id = 'HOT'").groupBy(F.spark_partition_id()).count()
        counts = [r["count"] for r in per_task.collect()]
        assert sum(counts) == 20_000 and len(counts) > 1 and max(counts) < 15_000
        assert fact.filter("invoice_id = 'HOT' AND net_invoice_amount = 3").count() == 20_000
    finally:
        for key in conf:
            spark.conf.unset(key)


def test_aqe_splits_the_charge_join(spark, landed):
    """The charges come out of an aggregation by invoice; the slot gives the join shuffles of
    its own, which is what AQE's skew handling needs."""
    rows = spark.range(200_000).select(
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("I"), F.col("id")))
        .alias("INVOICEID"),
        F.lit(1).alias("LINENUM"), F.md5(F.col("id").cast("string")).alias("INVOICEACCOUNT"),
        F.lit("P1").alias("ITEMID"), F.lit(D).alias("INVOICEDATE"), F.lit(1).alias("QTY"),
        F.lit(1.0).alias("SALESPRICE"), F.lit(1.0).alias("LINEAMOUNT"),
        F.lit(0.0).alias("TAXAMOUNT"), F.lit("USD").alias("CURRENCYCODE"),
    ).repartition(8)
    charges = rows.select("INVOICEID", F.lit("FREIGHT").alias("MARKUPCODE"),
                          F.lit(1.0).alias("VALUE")).distinct()
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1000",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100000"}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        fact = facts.fact_invoice_lines(rows, charges, landed[2])
        assert "skew=true" in final_plan(fact.agg(F.max("customer_key"), F.sum("freight_amount")))
    finally:
        for key in conf:
            spark.conf.unset(key)


def test_customer_is_cleaned(spark):
    shape = ("ACCOUNTNUM string, NAME string, EMAIL string, PHONE string, ADDRESS_LINE1 string,"
             " CITY string, STATE_PROVINCE string, POSTAL_CODE string, COUNTRY string,"
             " TERRITORY string, CUSTGROUP string, BLOCKED int, CREDITLIMIT_USD double,"
             " CREATEDDATETIME timestamp, MODIFIEDDATETIME timestamp")
    rows = [("C1", " Ann ", " A@B.com ", *[None] * 8, 1, 5.0, None, None),
            ("C2", "Bob", None, *[None] * 8, None, 5.0, None, None)]
    got = dims.dim_customer(spark.createDataFrame(rows, shape))
    assert listed(got, "customer_name", "email", "is_active") == [
        ("Ann", "a@b.com", False), ("Bob", None, True)]
    assert dims.LOADED_AT in got.columns


def test_calendar(spark):
    days = dims.dim_date(spark)
    assert days.count() == 3652
    leap = days.filter("date_key = DATE '2020-02-29'").first()
    assert (leap.year_quarter, leap.day_of_week, leap.day_name, leap.month_name,
            leap.is_weekend) == ("2020-Q1", 7, "Saturday", "Feb", True)
    ends = days.agg(F.min("date_key"), F.max("date_key")).first()
    assert tuple(ends) == (dt.date(2018, 1, 1), dt.date(2027, 12, 31))
    assert days.filter("is_weekend <> (day_of_week IN (1, 7))").count() == 0


def test_regions(spark):
    assert dims.dim_region(spark).count() == 4


def test_dedupe_keeps_the_newest(spark):
    rows = [("a", 1, "x"), ("a", 3, "y"), ("a", 3, "z"), ("b", 2, "w"), (None, 1, "n")]
    df = spark.createDataFrame(rows, "k string, at int, v string")
    got = dims.dedupe_latest(df, "k", [F.desc("at"), F.desc("v")])
    assert listed(got) == sorted([("a", 3, "z"), ("b", 2, "w"), (None, 1, "n")], key=repr)


def test_dedupe_limits_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS v")
    plan = dims.dedupe_latest(df, "k", [F.desc("v")])._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_stages_and_lead_events(spark):
    deals = spark.createDataFrame(
        [("closedwon",), ("closedlost",), ("contractsent",), (None,)], "DEALSTAGE string"
    ).selectExpr("'d' DEAL_ID", "'n' DEAL_NAME", "1D AMOUNT_USD", "DEALSTAGE",
                 "'c' ASSOCIATED_ACCOUNTNUM", "current_date() CREATED_AT", "'t' TERRITORY",
                 "'l' LEAD_SOURCE")
    outcomes = [r.deal_outcome for r in facts.fact_crm_deals(deals).collect()]
    assert sorted(outcomes) == ["LOST", "OPEN", "OPEN", "WON"]


def test_lines_without_a_number_get_their_share(spark):
    from lakehouse_kpis.operators.facts import _divided

    lines = spark.createDataFrame(
        [("i", 1, 1.0), ("i", None, 2.0), ("i", 2, 3.0)], "invoice_id string, line_num int, v double"
    )
    charges = spark.sql(
        "SELECT 'i' AS invoice_id, 10.00BD AS freight_amount, -0.01BD AS discount_amount, 0.00BD AS pallet_amount"
    )
    rows = {r.line_num: r for r in _divided(lines, charges).collect()}
    assert [str(rows[n].freight_amount) for n in (None, 1, 2)] == ["3.34", "3.33", "3.33"]
    assert sum(r.discount_amount for r in rows.values()) == charges.first().discount_amount


def test_calendar_covers_the_days_of_the_facts(spark):
    days = spark.createDataFrame([(dt.date(1995, 6, 17),), (None,)], "INVOICEDATE date")
    late = spark.createDataFrame([(dt.date(2031, 2, 3),)], "TRANSDATE date")
    none = spark.createDataFrame([], "CREATED_AT date")
    found = dims.dim_date_over([days, late, none])
    ends = found.agg(F.min("date_key"), F.max("date_key"), F.count("*")).first()
    assert tuple(ends) == (dt.date(1995, 1, 1), dt.date(2031, 12, 31), 13514)
    assert found.distinct().count() == 13514
    assert listed(dims.dim_date_over([none])) == listed(dims.dim_date(spark))


@pytest.mark.parametrize("keys, computed", [
    ([f"P{i}" for i in range(3, 10)], True),
    ([f"ITM{i:04d}" for i in range(95, 102)], True),
    ([f"P{i}" for i in range(7, 14)], False),           # the width grows
    ([f"P{i}" for i in (0, 1, 2, 3, 5, 6, 7)], False),  # a gap
    (["A0", "B1", "B2", "B3", "B4", "B5", "B6"], False),
    (list("abcdefg"), False),
])
def test_legacy_invoices_get_products_of_the_table(spark, keys, computed):
    products = spark.createDataFrame([(k,) for k in [*keys, None, keys[0]]], "ITEMID string")
    headers = spark.range(500).select(F.concat(F.lit("I"), F.col("id")).alias("INVOICEID"))
    assert (facts.key_range(products) is not None) is computed
    placed = facts.with_product(headers, products)
    counts = placed.groupBy("_product").count().collect()
    assert {r["_product"] for r in counts} == set(keys)
    assert sum(r["count"] for r in counts) == 500 and min(r["count"] for r in counts) > 30
    assert listed(placed) == listed(facts.with_product(headers.repartition(5), products.repartition(3)))
    none = facts.with_product(headers, products.limit(0))
    assert none.count() == 500 and none.where("_product IS NOT NULL").count() == 0
