"""Declared schemas of every layer table (the contract the operators meet).

Bronze tables arrive as text (types are not declared by the source; casts
happen in silver) plus the two audit columns. Silver keeps exact decimals for
prices and amounts; gold exposes money as double and counts as bigint. Audit
timestamps are included as produced with ``audit=True``.

``tests/test_schemas.py`` checks that the operators produce exactly these
column names and types.
"""

from __future__ import annotations

import re

from pyspark.sql import types as T

_SIMPLE = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "double": T.DoubleType(),
}


def _type(name: str) -> T.DataType:
    m = re.fullmatch(r"decimal\((\d+),(\d+)\)", name)
    return T.DecimalType(int(m.group(1)), int(m.group(2))) if m else _SIMPLE[name]


def _struct(cols: list[tuple[str, str]]) -> T.StructType:
    return T.StructType([T.StructField(n, _type(t), True) for n, t in cols])


_BRONZE_AUDIT = [("bronze_ingestion_timestamp", "timestamp"), ("bronze_source_table", "string")]

BRONZE_COLUMNS = {
    "order_items": [
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
    ],
    "order_item_options": ["ORDER_ID", "LINEITEM_ID", "OPTION_GROUP_NAME", "OPTION_NAME", "OPTION_PRICE", "OPTION_QUANTITY"],
    "date_dim": ["date_key", "year", "month", "week", "day_of_week", "is_weekend", "is_holiday", "holiday_name"],
}


def bronze_schema(table: str, audit: bool = False) -> T.StructType:
    """Source-shaped text schema of a bronze table (optionally with audit columns)."""
    cols = [(c, "string") for c in BRONZE_COLUMNS[table]]
    return _struct(cols + (_BRONZE_AUDIT if audit else []))


SILVER = {
    "order_items": _struct(
        [
            ("app_name", "string"),
            ("restaurant_id", "string"),
            ("creation_time_utc_raw", "string"),
            ("order_id", "string"),
            ("user_id", "string"),
            ("printed_card_number", "bigint"),
            ("is_loyalty", "boolean"),
            ("currency", "string"),
            ("lineitem_id", "string"),
            ("item_category", "string"),
            ("item_name", "string"),
            ("item_price", "decimal(27,10)"),
            ("item_quantity", "int"),
            ("creation_timestamp_utc", "timestamp"),
            ("order_date", "date"),
            ("loyalty_status", "string"),
            ("item_gross_amount", "decimal(18,2)"),
            ("silver_processed_timestamp", "timestamp"),
        ]
    ),
    "order_item_options": _struct(
        [
            ("order_id", "string"),
            ("lineitem_id", "string"),
            ("option_group_name", "string"),
            ("option_name", "string"),
            ("option_price", "decimal(27,10)"),
            ("option_quantity", "int"),
            ("option_gross_amount", "decimal(18,2)"),
            ("silver_processed_timestamp", "timestamp"),
        ]
    ),
    "date_dim": _struct(
        [
            ("date_key", "date"),
            ("year", "int"),
            ("month", "int"),
            ("week", "int"),
            ("day_of_week", "string"),
            ("is_weekend", "boolean"),
            ("is_holiday", "boolean"),
            ("holiday_name", "string"),
            ("day_type", "string"),
            ("silver_processed_timestamp", "timestamp"),
        ]
    ),
}

GOLD = {
    "customer_ltv_daily": _struct(
        [
            ("user_id", "string"),
            ("order_date", "date"),
            ("daily_revenue", "double"),
            ("daily_order_count", "bigint"),
            ("customer_ltv_to_date", "double"),
            ("lifetime_order_count_to_date", "bigint"),
            ("clv_group", "string"),
            ("gold_processed_timestamp", "timestamp"),
        ]
    ),
    "customer_segments": _struct(
        [
            ("user_id", "string"),
            ("last_order_date", "date"),
            ("first_order_date", "date"),
            ("frequency_orders", "bigint"),
            ("monetary_total_spend", "double"),
            ("recency_days", "int"),
            ("average_gap_between_orders_days", "double"),
            ("last_30_day_spend", "double"),
            ("previous_30_day_spend", "double"),
            ("spend_change_pct", "double"),
            ("rfm_segment", "string"),
            ("inactivity_tag", "string"),
            ("gold_processed_timestamp", "timestamp"),
        ]
    ),
    "sales_trends": _struct(
        [
            ("period_type", "string"),
            ("period_value", "string"),
            ("restaurant_id", "string"),
            ("item_category", "string"),
            ("currency", "string"),
            ("total_revenue", "double"),
            ("order_count", "bigint"),
            ("customer_count", "bigint"),
            ("gold_processed_timestamp", "timestamp"),
        ]
    ),
    "loyalty_location_discount": _struct(
        [
            ("metric_type", "string"),
            ("metric_dimension", "string"),
            ("currency", "string"),
            ("total_revenue", "double"),
            ("total_orders", "bigint"),
            ("total_customers", "bigint"),
            ("average_order_value", "double"),
            ("gold_processed_timestamp", "timestamp"),
        ]
    ),
}


def mart_columns(mart: str) -> list[str]:
    """The columns of a gold mart without its audit column."""
    return [n for n in GOLD[mart].names if n != "gold_processed_timestamp"]


def names_and_types(schema: T.StructType) -> list[tuple[str, str]]:
    """(name, simpleString type) pairs, ignoring nullability."""
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def require_bronze_columns(df, table: str) -> None:
    """Fail fast when a source lacks a column the cleaning rules read (column
    names are matched case-insensitively, like Spark's resolver); extra
    source columns are allowed."""
    have = {c.lower() for c in df.columns}
    missing = [c for c in BRONZE_COLUMNS[table] if c.lower() not in have]
    if missing:
        raise ValueError(f"source table {table!r} lacks columns {missing}")
