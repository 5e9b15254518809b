"""Gold marts (M1-M4) composed from silver inputs, with money columns turned
into doubles only at the output boundary.

Every function takes silver DataFrames (``order_items``, ``order_item_options``)
and returns a lazy DataFrame; writing is the sink's job.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.config import DEFAULT_THRESHOLDS, Thresholds
from ledgerline.functions.columns import money_to_double as _doubles
from ledgerline.operators import customers, metrics, revenue, trends
from ledgerline.schemas import mart_columns


def customer_orders(items: DataFrame, options: DataFrame, line_count: bool = False) -> DataFrame:
    return revenue.order_revenue(items, options, revenue.CUSTOMER_GRAIN, line_count=line_count)


def store_orders(items: DataFrame, options: DataFrame) -> DataFrame:
    return revenue.order_revenue(items, options, revenue.STORE_GRAIN, with_discount=True)


LTV_COLUMNS = mart_columns("customer_ltv_daily")


def customer_ltv_daily(
    items: DataFrame,
    options: DataFrame,
    thresholds: Thresholds = DEFAULT_THRESHOLDS,
    audit: bool = False,
    orders: DataFrame | None = None,
) -> DataFrame:
    """M1. ``orders``: precomputed customer-grain orders (e.g. written once
    per pipeline run and shared with M2); built from items/options if None."""
    orders = orders if orders is not None else customer_orders(items, options)
    daily = revenue.daily_customer_revenue(orders)
    out = customers.customer_ltv_daily(daily, thresholds).select(*LTV_COLUMNS)
    out = _doubles(out, ["daily_revenue", "customer_ltv_to_date"])
    return out.withColumn("gold_processed_timestamp", F.current_timestamp()) if audit else out


def customer_segments(
    items: DataFrame,
    options: DataFrame,
    as_of: _dt.date | str | None = None,
    thresholds: Thresholds = DEFAULT_THRESHOLDS,
    audit: bool = False,
    orders: DataFrame | None = None,
) -> DataFrame:
    """M2. ``orders`` as for M1."""
    orders = orders if orders is not None else customer_orders(items, options)
    out = customers.customer_segments(orders, as_of, thresholds)
    out = _doubles(
        out,
        [
            "monetary_total_spend",
            "average_gap_between_orders_days",
            "last_30_day_spend",
            "previous_30_day_spend",
            "spend_change_pct",
        ],
    )
    return out.withColumn("gold_processed_timestamp", F.current_timestamp()) if audit else out


def sales_trends(items: DataFrame, method: str = "levels", audit: bool = False) -> DataFrame:
    """M3."""
    out = _doubles(trends.sales_trends(items, method=method), ["total_revenue"])
    return out.withColumn("gold_processed_timestamp", F.current_timestamp()) if audit else out


def loyalty_location_discount(
    items: DataFrame,
    options: DataFrame,
    method: str = "stacked",
    audit: bool = False,
    orders: DataFrame | None = None,
) -> DataFrame:
    """M4. ``orders``: precomputed store-grain orders."""
    orders = orders if orders is not None else store_orders(items, options)
    out = metrics.loyalty_location_discount(orders, method)
    out = _doubles(out, ["total_revenue", "average_order_value"])
    return out.withColumn("gold_processed_timestamp", F.current_timestamp()) if audit else out
