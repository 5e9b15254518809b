import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import ArithmeticException
from pyspark.sql import functions as F

from ledgerline.functions import columns as C


def _one(spark, expr, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"x {dtype}")
    return df.select(expr(F.col("x")).alias("y")).first().y


def test_safe_int(spark):
    assert _one(spark, C.safe_int, "2.7") == 2
    assert _one(spark, C.safe_int, "-2.7") == -2
    assert _one(spark, C.safe_int, " 3 ") == 3
    assert _one(spark, C.safe_int, "abc") is None
    assert _one(spark, C.safe_int, "99999999999") is None  # out of int range
    assert _one(spark, C.safe_int, None) is None
    assert _one(spark, C.safe_int, "1e3") is None  # a cast to int takes no exponent
    assert _one(spark, C.safe_int, ".5") == 0 and _one(spark, C.safe_int, "-7.") == -7


def test_safe_price_and_amount(spark):
    assert _one(spark, C.safe_price, "n/a") is None
    assert _one(spark, C.safe_price, "NaN") is None
    assert _one(spark, C.safe_price, "10.50") == Decimal("10.5")
    for text, price in (("100000000000000", "1e14"), ("1e14", "1e14"), ("0.00004", "0.00004"), ("10.12345", "10.12345"), ("5d", "5"), ("5f", "5")):
        assert _one(spark, C.safe_price, text) == Decimal(price)
    assert _one(spark, lambda x: C.line_amount(C.safe_price(x), F.lit(100000)), "10.12345") == Decimal("1012345.00")
    with pytest.raises(ArithmeticException):
        _one(spark, C.safe_price, "1e30")  # a number that has no place is not dropped
    df = spark.createDataFrame([("0.285", 1), ("10.125", 1), ("-0.125", 1)], "p string, q int")
    got = [r.a for r in df.select(C.line_amount(C.safe_price("p"), "q").alias("a")).collect()]
    assert got == [Decimal("0.29"), Decimal("10.13"), Decimal("-0.13")]  # exact half-up


def test_clean_label(spark):
    assert _one(spark, C.clean_label, None) == "unknown"
    assert _one(spark, C.clean_label, "   ") == "unknown"
    assert _one(spark, C.clean_label, " Pizza ") == "pizza"


def test_bool_label(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "b boolean")
    got = [r.l for r in df.select(C.bool_label("b", "yes", "no").alias("l")).collect()]
    assert got == ["yes", "no", "no"]


def test_period_keys(spark):
    df = spark.createDataFrame([(dt.date(2021, 1, 1),), (dt.date(2024, 12, 30),), (dt.date(2024, 3, 5),)], "d date")
    got = df.select(C.year_week_key("d").alias("w"), C.year_week_key("d", iso_year=True).alias("iw"), C.year_month_key("d").alias("m")).collect()
    assert [r.w for r in got] == ["2021-W53", "2024-W01", "2024-W10"]  # calendar year + ISO week (T11)
    assert [r.iw for r in got] == ["2020-W53", "2025-W01", "2024-W10"]
    assert [r.m for r in got] == ["2021-01", "2024-12", "2024-03"]


def test_pct_change(spark):
    df = spark.createDataFrame(
        [(Decimal("46.25"), Decimal("0")), (Decimal("0"), Decimal("32.00")), (Decimal("1.00"), Decimal("3.00")), (None, None)],
        "c decimal(18,2), p decimal(18,2)",
    )
    got = [r.x for r in df.select(C.pct_change("c", "p").alias("x")).collect()]
    assert got == [None, Decimal("-100.00"), Decimal("-66.67"), None]


def test_cluster_conf_sizing():
    from ledgerline.session import cluster_conf

    c = cluster_conf(100 * 1024**4, 1000, 8)
    assert int(c["spark.sql.shuffle.partitions"]) == 40960  # 10% of 100 TB in 256 MB partitions
    assert int(c["spark.sql.autoBroadcastJoinThreshold"]) == 64 * 1024**2
    small = cluster_conf(10 * 1024**2, 2, 4)
    assert int(small["spark.sql.shuffle.partitions"]) == 24  # at least 3 tasks per core
