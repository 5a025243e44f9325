"""What is shuffled grows no faster than the rows."""

import datetime as dt

import pytest

import __spark_entry__ as entry
from lakehouse_kpis.operators import gold, rollups
from lakehouse_kpis.session import written

SMALL = "/root/testdata/sf0.001"


def plan(df) -> list[str]:
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0].splitlines()


@pytest.fixture(scope="module")
def lake(spark):
    return entry.lakehouse(spark, SMALL)


def test_numbers_are_shuffled_not_bitmaps(lake):
    made = rollups._bitmaps(
        lake.metrics, {"Territory": "`customer`.territory"}, "Active Customers",
        "source.customer_key", "source.invoice_date",
    )
    lines = plan(made)
    agg = [i for i, line in enumerate(lines) if "bitmap_construct_agg" in line]
    assert len(agg) == 2  # merged and partial, with no shuffle of bitmaps in between
    assert not any("Exchange" in line for line in lines[agg[0]:agg[1]])


def test_dates_of_the_ageing_series_are_added_up_where_they_are_made(lake):
    lines = plan(gold.ar_aging_series(
        lake.table("fact_invoice_lines"), [dt.date(2000, 1, 31), dt.date(2000, 2, 29)]
    ))
    copies = next(i for i, line in enumerate(lines) if "Generate explode" in line)
    assert not any("Exchange" in line for line in lines[:copies])


def test_changing_lines_are_made_once(lake, monkeypatch):
    kept = []

    def once(df, name):
        kept.append((name, df))
        return written(df, name)

    monkeypatch.setattr(entry, "written", once)
    assert entry._summary_after_changes(lake).count() > 0
    assert [name for name, _ in kept] == ["changing-lines"]
