from decimal import Decimal

from pyspark.sql import functions as F

from conftest import DATE_COLS, text_df
from ledgerline.operators import silver


def test_order_items_golden(golden):
    rows = {(r.order_id, r.lineitem_id): r for r in golden["items"].collect()}
    assert golden["items"].count() == 16  # r4 (bad price) and r18 (NULL order) dropped
    r1 = rows[("O1", "O1-1")]
    assert r1.item_category == "pizza" and r1.currency == "USD" and r1.loyalty_status == "loyalty"
    assert r1.item_gross_amount == Decimal("21.00") and r1.app_name == "app"
    r2 = rows[("O1", "O1-2")]
    assert (r2.item_category, r2.item_name, r2.item_gross_amount) == ("unknown", "unknown", Decimal("4.25"))
    r5 = rows[("O2", "O2-1")]
    assert r5.item_quantity == 2 and r5.item_gross_amount == Decimal("2.00")  # '2.7' truncates (T2)
    assert r5.loyalty_status == "non_loyalty"  # NULL loyalty (T4)
    assert ("O1", "O1-3") not in rows  # malformed price (T1)
    r17 = rows[("", "x-1")]  # blank id survives as '' (T3)
    assert r17.order_date is None
    assert rows[("O12", "O12-1")].order_date is None  # bad date kept (T9)
    assert rows[("O11", "O11-1")].user_id is None  # NULL user kept (T8)
    # duplicates kept
    assert golden["items"].filter((F.col("order_id") == "O1") & (F.col("lineitem_id") == "O1-1")).count() == 2


def test_order_items_schema(golden):
    types = dict(golden["items"].dtypes)
    assert types["printed_card_number"] == "bigint"
    assert types["is_loyalty"] == "boolean"
    assert types["item_quantity"] == "int"
    assert types["order_date"] == "date"
    assert types["creation_timestamp_utc"] == "timestamp"
    assert types["item_gross_amount"].startswith("decimal")
    assert set(silver.ORDER_ITEM_COLUMNS) == set(golden["items"].columns)


def test_options_golden(golden):
    assert golden["options"].columns == silver.OPTION_COLUMNS
    rows = sorted((r.option_group_name, r.option_name, r.option_gross_amount) for r in golden["options"].collect())
    assert rows == [
        ("discounts", "promo", Decimal("-5.00")),
        ("extras", "cheese", Decimal("3.00")),
        ("unknown", "unknown", Decimal("1.00")),
    ]


def test_audit_column(golden):
    out = silver.order_items(golden["bronze_items"], audit=True)
    assert "silver_processed_timestamp" in out.columns


def test_date_dim(spark):
    rows = [
        ("2024-01-01", "2024", "1", "1", " MONDAY ", "false", "true", " New Year "),
        ("2024-06-01", "2024", "6", "22", "Saturday", None, "false", None),  # NULL weekend -> weekday
        ("2024-06-02", "2024", "6", "22.0", " sunday", "true", "false", None),
        ("bad-key", "2024", "6", "22", "Monday", "false", "false", None),  # dropped
    ]
    dd = silver.date_dim(text_df(spark, DATE_COLS, rows))
    assert dd.columns == silver.DATE_DIM_COLUMNS
    out = {r.date_key.isoformat(): r for r in dd.collect()}
    assert len(out) == 3
    assert out["2024-01-01"].day_of_week == "monday" and out["2024-01-01"].holiday_name == "New Year"
    assert out["2024-01-01"].is_holiday is True
    assert out["2024-06-01"].day_type == "weekday" and out["2024-06-01"].is_weekend is None
    assert out["2024-06-02"].day_type == "weekend" and out["2024-06-02"].week == 22
