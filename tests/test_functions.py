import datetime as dt

import pytest
from conftest import listed
from pyspark.sql import functions as F

from lakehouse_kpis.functions import masks
from lakehouse_kpis.functions.dates import month_start, months_before
from lakehouse_kpis.functions.money import mean, money, published, ratio
from lakehouse_kpis.functions.text import business_key, decode, pick


@pytest.mark.parametrize("mask, value, shown", [
    ("email", "a@b.com", "***@b.com"),
    ("email", "a@b@c", "***@b"),
    ("email", "no-at-sign", "***"),
    ("email", "", "***"),
    ("email", None, None),
    ("phone", "+1-555-0100-1736", "***-***-1736"),
    ("phone", "123", "***-***-123"),
    ("phone", None, None),
    ("address", "1 Oak St", "[REDACTED]"),
    ("address", None, None),
    ("ssn", "123-45-6789", "XXX-XX-XXXX"),
    ("ssn", None, None),
    ("salary", "100", None),
])
def test_masks(spark, mask, value, shown):
    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(masks.MASKS[mask](F.col("v"))).first()[0] == shown


def test_business_key_grows_past_its_width(spark):
    df = spark.createDataFrame([(7,), (9999999,), (12345678901,)], "n bigint")
    keys = [r[0] for r in df.select(business_key("INV-", F.col("n"), 7)).collect()]
    assert keys == ["INV-0000007", "INV-9999999", "INV-12345678901"]


def test_decode_and_pick(spark):
    df = spark.createDataFrame([("PAV", 4), ("ZZZ", 5), (None, 6)], "code string, n int")
    decoded = decode(F.col("code"), {"PAV": "Pavers"}, "Other")
    assert listed(df.select("n", decoded, pick(["a", "b", "c"], F.col("n")))) == [
        (4, "Pavers", "b"), (5, "Other", "c"), (6, "Other", "a")]


def test_money_is_exact_and_published_as_double(spark):
    df = spark.createDataFrame([(0.1,)] * 10 + [(None,)], "v double").select(money("v").alias("v"))
    total = published(df.agg(F.sum("v").alias("s"), mean("v").alias("m")))
    assert dict(total.dtypes) == {"s": "double", "m": "double"}
    assert tuple(total.first()) == (1.0, 0.1)


def test_ratio_of_zero_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.0)], "a double, b double")
    assert df.select(ratio(F.col("a"), F.col("b"))).first()[0] is None


def test_month_arithmetic():
    assert month_start(dt.date(2001, 8, 31), -12) == dt.date(2000, 8, 1)
    assert month_start(dt.date(2001, 1, 5), -1) == dt.date(2000, 12, 1)
    assert months_before(dt.date(2001, 8, 31), 6) == dt.date(2001, 2, 28)
    assert months_before(dt.date(2001, 8, 31), 60) == dt.date(1996, 8, 31)
