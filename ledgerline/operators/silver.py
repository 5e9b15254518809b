"""Silver cleaning: rename to snake_case, tolerant casts, quality filters, labels.

All three are narrow plans (projection + filter, no shuffle), so they scale
linearly and Catalyst pushes the not-NULL filters into the same codegen stage.

Rules kept from the source system:
  * a malformed price / quantity parses to NULL and the row is dropped;
  * quantities truncate toward zero ('2.7' -> 2);
  * only NULL ids are rejected, an empty id survives as '';
  * NULL/false loyalty -> 'non_loyalty'; NULL weekend flag -> 'weekday';
  * blank or NULL category/item/option text -> 'unknown', else lower case;
  * no de-duplication (duplicate lines are kept).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.config import LOYALTY_LABEL, NON_LOYALTY_LABEL, WEEKDAY_LABEL, WEEKEND_LABEL
from ledgerline.functions.columns import (
    bool_label,
    clean_label,
    clean_text,
    line_amount,
    safe_bool,
    safe_date,
    safe_int,
    safe_long,
    safe_price,
    safe_timestamp,
)

ORDER_ITEM_COLUMNS = [
    "app_name",
    "restaurant_id",
    "creation_time_utc_raw",
    "order_id",
    "user_id",
    "printed_card_number",
    "is_loyalty",
    "currency",
    "lineitem_id",
    "item_category",
    "item_name",
    "item_price",
    "item_quantity",
    "creation_timestamp_utc",
    "order_date",
    "loyalty_status",
    "item_gross_amount",
]

OPTION_COLUMNS = [
    "order_id",
    "lineitem_id",
    "option_group_name",
    "option_name",
    "option_price",
    "option_quantity",
    "option_gross_amount",
]

DATE_DIM_COLUMNS = [
    "date_key",
    "year",
    "month",
    "week",
    "day_of_week",
    "is_weekend",
    "is_holiday",
    "holiday_name",
    "day_type",
]


def _stamp(df: DataFrame, audit: bool, name: str = "silver_processed_timestamp") -> DataFrame:
    return df.withColumn(name, F.current_timestamp()) if audit else df


def order_items(bronze: DataFrame, audit: bool = False) -> DataFrame:
    """Silver order lines."""
    typed = bronze.select(
        clean_text("APP_NAME").alias("app_name"),
        clean_text("RESTAURANT_ID").alias("restaurant_id"),
        clean_text("CREATION_TIME_UTC").alias("creation_time_utc_raw"),
        clean_text("ORDER_ID").alias("order_id"),
        clean_text("USER_ID").alias("user_id"),
        safe_long("PRINTED_CARD_NUMBER").alias("printed_card_number"),
        safe_bool("IS_LOYALTY").alias("is_loyalty"),
        F.upper(clean_text("CURRENCY")).alias("currency"),
        clean_text("LINEITEM_ID").alias("lineitem_id"),
        clean_label("ITEM_CATEGORY").alias("item_category"),
        clean_label("ITEM_NAME").alias("item_name"),
        safe_price("ITEM_PRICE").alias("item_price"),
        safe_int("ITEM_QUANTITY").alias("item_quantity"),
    ).filter(
        F.col("order_id").isNotNull()
        & F.col("lineitem_id").isNotNull()
        & F.col("item_price").isNotNull()
        & F.col("item_quantity").isNotNull()
    )
    ts = safe_timestamp("creation_time_utc_raw")
    out = typed.select(
        *[c for c in typed.columns],
        ts.alias("creation_timestamp_utc"),
        F.to_date(ts).alias("order_date"),
        bool_label("is_loyalty", LOYALTY_LABEL, NON_LOYALTY_LABEL).alias("loyalty_status"),
        line_amount("item_price", "item_quantity").alias("item_gross_amount"),
    )
    return _stamp(out, audit)


def order_item_options(bronze: DataFrame, audit: bool = False) -> DataFrame:
    """Silver order-line options (P2, P4). Negative price = discount."""
    typed = bronze.select(
        clean_text("ORDER_ID").alias("order_id"),
        clean_text("LINEITEM_ID").alias("lineitem_id"),
        clean_label("OPTION_GROUP_NAME").alias("option_group_name"),
        clean_label("OPTION_NAME").alias("option_name"),
        safe_price("OPTION_PRICE").alias("option_price"),
        safe_int("OPTION_QUANTITY").alias("option_quantity"),
    ).filter(
        F.col("order_id").isNotNull()
        & F.col("lineitem_id").isNotNull()
        & F.col("option_price").isNotNull()
        & F.col("option_quantity").isNotNull()
    )
    out = typed.withColumn("option_gross_amount", line_amount("option_price", "option_quantity"))
    return _stamp(out, audit)


def date_dim(bronze: DataFrame, audit: bool = False) -> DataFrame:
    """Silver calendar."""
    out = (
        bronze.select(
            safe_date("date_key").alias("date_key"),
            safe_int("year").alias("year"),
            safe_int("month").alias("month"),
            safe_int("week").alias("week"),
            F.lower(clean_text("day_of_week")).alias("day_of_week"),
            safe_bool("is_weekend").alias("is_weekend"),
            safe_bool("is_holiday").alias("is_holiday"),
            clean_text("holiday_name").alias("holiday_name"),
        )
        .filter(F.col("date_key").isNotNull())
        .withColumn("day_type", bool_label("is_weekend", WEEKEND_LABEL, WEEKDAY_LABEL))
    )
    return _stamp(out, audit)
