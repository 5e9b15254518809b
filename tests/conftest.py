from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql.types import StringType, StructField, StructType  # noqa: E402

from ledgerline.session import build_session  # noqa: E402

GOLDEN_AS_OF = dt.date(2024, 7, 1)

ITEM_COLS = [
    "APP_NAME",
    "RESTAURANT_ID",
    "CREATION_TIME_UTC",
    "ORDER_ID",
    "USER_ID",
    "PRINTED_CARD_NUMBER",
    "IS_LOYALTY",
    "CURRENCY",
    "LINEITEM_ID",
    "ITEM_CATEGORY",
    "ITEM_NAME",
    "ITEM_PRICE",
    "ITEM_QUANTITY",
]
OPTION_COLS = ["ORDER_ID", "LINEITEM_ID", "OPTION_GROUP_NAME", "OPTION_NAME", "OPTION_PRICE", "OPTION_QUANTITY"]
DATE_COLS = ["date_key", "year", "month", "week", "day_of_week", "is_weekend", "is_holiday", "holiday_name"]


def _line(order, line, user, created, loyal, category, price, qty, name="Margherita", currency=" usd ", rest="R1"):
    return (" app ", rest, created, order, user, "4111111111111111", loyal, currency, line, category, name, price, qty)


def golden_item_rows():
    """Hand-built order lines (FIXTURES section 2)."""
    t620 = "2024-06-20 10:00:00"
    rows = [
        _line("O1", "O1-1", "U1", t620, "true", " Pizza ", "10.50", "2"),  # r1
        _line("O1", "O1-2", "U1", t620, "true", None, "4.25", "1", name="  "),  # r2
        _line("O1", "O1-1", "U1", t620, "true", " Pizza ", "10.50", "2"),  # r3 copy of r1
        _line("O1", "O1-3", "U1", t620, "true", "Pizza", "n/a", "1"),  # r4 dropped
        _line("O2", "O2-1", "U1", "2024-06-05 09:00:00", None, "Salad", "1.00", "2.7"),  # r5
        _line("O3", "O3-1", "U2", "2024-05-30", "false", "Salad", "10.00", "1"),  # r6
        _line("O3", "O3-2", "U2", "2024-05-31", "false", "Salad", "20.00", "1"),  # r7
        _line("O4", "O4-1", "U3", "2024-01-10", "false", "Salad", "5.00", "1"),  # r8
        _line("O5", "O5-1", "U4", "2024-07-10", "false", "Salad", "30.00", "1"),  # r9
    ]
    for k, day in enumerate([10, 12, 14, 16, 20]):  # r10-r14
        rows.append(_line(f"O{6 + k}", f"O{6 + k}-1", "U5", f"2024-06-{day:02d}", "true", "Salad", "120.00", "1"))
    rows += [
        _line("O11", "O11-1", None, "2024-06-20", "false", "Salad", "7.00", "1"),  # r15
        _line("O12", "O12-1", "U1", "not-a-date", "true", "Salad", "8.00", "1"),  # r16
        _line("  ", "x-1", "U6", "not-a-date", "false", "Salad", "1.00", "1"),  # r17
        _line(None, "x-2", "U6", "2024-06-20", "false", "Salad", "1.00", "1"),  # r18 dropped
    ]
    return rows


def golden_option_rows():
    return [
        ("O1", "O1-1", "Extras", "Cheese", "1.50", "2"),
        ("O1", "O1-1", "Discounts", "Promo", "-5.00", "1"),
        ("O3", "O3-1", " ", None, "1.00", "1"),
    ]


def text_df(spark, cols, rows):
    schema = StructType([StructField(c, StringType(), True) for c in cols])
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    s = build_session(
        "local[4]",
        app_name="ledgerline-tests",
        shuffle_partitions=8,
        extra_conf={"spark.default.parallelism": "4"},
    )
    s.sparkContext.setLogLevel("ERROR")
    # tests only: a scratch checkpoint folder when the session names none
    if not s.sparkContext.getCheckpointDir() and not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerline-test-ckpt-"))
    yield s


@pytest.fixture(scope="session")
def golden(spark):
    from ledgerline.operators import silver

    bi = text_df(spark, ITEM_COLS, golden_item_rows())
    bo = text_df(spark, OPTION_COLS, golden_option_rows())
    return {
        "bronze_items": bi,
        "bronze_options": bo,
        "items": silver.order_items(bi),
        "options": silver.order_item_options(bo),
    }


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="ledgerline-test-")
