import datetime as dt
import uuid

import pytest
from conftest import first_plan, listed
from pyspark.sql import functions as F

from lakehouse_kpis.operators import dims, facts
from lakehouse_kpis.operators.increment import MONTH, InvoiceFact
from lakehouse_kpis.session import shared_dir

LINES = ("INVOICEID string, LINENUM int, INVOICEACCOUNT string, ITEMID string, INVOICEDATE date, QTY int,"
         " SALESPRICE double, LINEAMOUNT double, TAXAMOUNT double, CURRENCYCODE string,"
         " _SINKMODIFIEDTIME timestamp_ntz")
MARKUPS = "INVOICEID string, MARKUPCODE string, VALUE double, TRANSDATE timestamp_ntz"
HEADERS = ("INVOICEID string, INVOICEACCOUNT string, INVOICEDATE date, INVOICEAMOUNT double,"
           " SALESTAXAMOUNT double, CURRENCYCODE string")
FIRST = dt.datetime(2025, 9, 1)
LATER = dt.datetime(2025, 9, 2)


def line(invoice, number, day, amount=10.0, sink=FIRST):
    return (invoice, number, "C1", "P1", day, 1, amount, amount, 1.0, "USD", sink)


def day(month, number=5):
    return dt.date(2025, month, number)


class Landed:
    """Landed tables that tests change between refreshes."""

    def __init__(self, spark):
        self.spark = spark
        self.lines = [line(f"I{m}", n, day(m), 10.0 * n) for m in range(1, 9) for n in (1, 2, 3)]
        self.lines += [line("SPAN", 1, day(2, 28)), line("SPAN", 2, day(3, 1))]
        self.markups = [(f"I{m}", "FREIGHT", 10.0, FIRST) for m in range(1, 9)]
        self.markups.append(("SPAN", "FREIGHT", 0.05, FIRST))
        self.headers = [(f"L{m}", "C2", day(m), 50.0, 4.0, "USD") for m in (1, 4)]
        self.products = [("P1",), ("P2",)]

    def table(self, name):
        rows, shape = {
            "invoice_lines": (self.lines, LINES), "markups": (self.markups, MARKUPS),
            "legacy_headers": (self.headers, HEADERS), "products": (self.products, "ITEMID string"),
        }[name]
        return self.spark.createDataFrame(rows, shape)


@pytest.fixture
def landed(spark):
    return Landed(spark)


def kept(spark, landed, allocation="repeat"):
    path = f"{shared_dir(spark)}/increment-{uuid.uuid4().hex}"
    return InvoiceFact(spark, path, landed.table, allocation)


def whole(landed, allocation):
    return listed(facts.fact_invoice_lines(
        *[landed.table(n) for n in ("invoice_lines", "markups", "legacy_headers")], allocation,
        products=landed.table("products"),
    ).drop(dims.LOADED_AT))


def stored(fact):
    return listed(fact.read().drop(dims.LOADED_AT, MONTH))


@pytest.mark.parametrize("allocation, also", [("repeat", set()), ("equal", {3})])
def test_a_day_and_a_late_charge(spark, landed, allocation, also):
    """One more day, a back-dated charge, a row written again, one that went and one that moved: the
    months they touch are rebuilt and the fact equals a full build."""
    fact = kept(spark, landed, allocation)
    assert fact.refresh() is None and stored(fact) == whole(landed, allocation)
    assert fact.refresh() == []

    landed.lines += [line("I9", 1, day(9), 7.0, LATER), line("SPAN", 3, day(2, 27), 3.0, LATER)]
    landed.markups.append(("I4", "PALLET", 45.0, dt.datetime(2024, 1, 1)))
    landed.lines.remove(line("I6", 2, day(6), 20.0))
    landed.lines.remove(line("I8", 1, day(8)))
    landed.lines.append(line("I8", 1, day(7), 10.0, LATER))
    rebuilt = fact.refresh()
    months = {2, 4, 6, 7, 8, 9} | also
    assert {dt.date.fromisoformat(m).month for m in rebuilt} == months
    assert stored(fact) == whole(landed, allocation)
    assert fact.refresh() == []


def test_changed_and_removed_charges(spark, landed):
    fact = kept(spark, landed)
    fact.refresh()
    landed.markups[0] = ("I1", "FREIGHT", 11.0, FIRST)
    landed.markups = [m for m in landed.markups if m[0] != "I5"] + [("NOWHERE", "FREIGHT", 1.0, LATER)]
    assert fact.refresh() == ["2025-01-01", "2025-05-01"]
    assert stored(fact) == whole(landed, "repeat")


def test_headers_and_products(spark, landed):
    fact = kept(spark, landed)
    fact.refresh()
    landed.headers[0] = ("L1", "C2", day(1), 60.0, 4.0, "USD")
    assert fact.refresh() == ["2025-01-01"]
    landed.products.append(("P3",))
    assert fact.refresh() == ["2025-01-01", "2025-04-01"]
    assert stored(fact) == whole(landed, "repeat")


def test_months_given_by_hand_leave_the_rest_to_be_found(spark, landed):
    fact = kept(spark, landed)
    fact.refresh()
    landed.markups += [("I2", "PALLET", 45.0, LATER), ("I3", "PALLET", 45.0, LATER)]
    assert fact.refresh([day(2, 1)]) == ["2025-02-01"]
    assert "2025-03-01" in fact.refresh()
    assert stored(fact) == whole(landed, "repeat")


def test_rows_without_a_date_and_empty_tables(spark, landed):
    landed.lines, landed.markups, landed.headers = [], [], []
    fact = kept(spark, landed)
    fact.refresh()
    assert stored(fact) == []
    landed.lines = [line("I1", 1, None)]
    assert fact.refresh() is None
    assert stored(fact) == whole(landed, "repeat") and len(stored(fact)) == 1


def test_snapshots_of_charges_do_not_pile_up(spark, landed):
    fact = kept(spark, landed)
    for amount in range(5):
        landed.markups[0] = ("I1", "FREIGHT", float(amount), FIRST)
        fact.refresh()
        fact.refresh()
    assert len(fact._files.found("charges/*")) == 2


def test_other_months_are_not_read(spark, landed, tmp_path):
    """Where the landed lines are stored by month, a rebuild lists the folders of its months alone."""
    path = f"{shared_dir(spark)}/landed-{uuid.uuid4().hex}"
    landed.table("invoice_lines").withColumn("INVOICEDATE_month", F.trunc("INVOICEDATE", "MONTH")).write \
        .partitionBy("INVOICEDATE_month").parquet(path)
    stored_lines = spark.read.parquet(path)
    fact = InvoiceFact(
        spark, f"{path}-fact", lambda n: stored_lines if n == "invoice_lines" else landed.table(n))
    plan = first_plan(fact.define([day(3, 1)]))
    scans = [part.splitlines()[0] for part in plan.split("FileScan parquet")[1:]]
    filters = [s.split("PartitionFilters: [")[1].split("PushedFilters")[0] for s in scans]
    assert filters and all("INVOICEDATE_month" in f for f in filters)


def test_the_query_lands_its_lines_once(spark, landed, monkeypatch):
    """Its two refreshes read the landed lines several times, and make them once."""
    import __spark_entry__ as entry

    monkeypatch.setattr(entry, "legacy_product_key", lambda: F.lit("P1"))
    made = []

    class Lake:
        def __init__(self):
            self.spark = spark

        def bronze(self, name):
            made.append(name)
            return landed.table(name).withColumns({c: F.lit("-") for c in ("DATAAREAID", "_SYSROWID")})

    found = entry._fact_by_increment(Lake())
    assert made.count("invoice_lines") == 1
    fact = facts.fact_invoice_lines(
        *[landed.table(n) for n in ("invoice_lines", "markups", "legacy_headers")],
        product_key=F.lit("P1"))
    assert listed(found) == listed(fact.drop(dims.LOADED_AT))
