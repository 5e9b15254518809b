"""Order revenue assembly shared by the customer and metrics marts.

Two order grains exist on purpose and are not merged:
  * ``CUSTOMER_GRAIN`` (user, order, date): rows with a NULL user, order or
    date are dropped (customer marts);
  * ``STORE_GRAIN`` (order, restaurant, user, loyalty flag/label, date,
    currency): only NULL orders are dropped (loyalty/location/discount mart).
Options are pre-aggregated per ``order_id`` and left-joined on ``order_id``
alone, so an order that spans several groups gets its whole option revenue in
each group (source behaviour). Missing option revenue becomes 0 after the join.

Shuffles: item revenue = partial aggregate map-side, one exchange on the grain
keys; option revenue = partial aggregate, one exchange on order_id; the join
re-partitions the (already aggregated, narrow) item side on order_id. AQE turns
the join into a broadcast only when a side measures under the broadcast
threshold at runtime.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.columns import money_round

# Fixed grains: what the marts group by.
CUSTOMER_GRAIN = ("user_id", "order_id", "order_date")
STORE_GRAIN = (
    "order_id",
    "restaurant_id",
    "user_id",
    "is_loyalty",
    "loyalty_status",
    "order_date",
    "currency",
)


def option_revenue(options: DataFrame, with_discount: bool = False) -> DataFrame:
    """Per order: option revenue, and optionally the discount part
    (sum of amounts whose unit price is negative, else 0)."""
    aggs = [F.sum("option_gross_amount").alias("option_revenue")]
    if with_discount:
        aggs.append(
            F.sum(F.when(F.col("option_price") < 0, F.col("option_gross_amount")).otherwise(F.lit(0))).alias(
                "discount_amount"
            )
        )
    return options.filter(F.col("order_id").isNotNull()).groupBy("order_id").agg(*aggs)


def item_revenue(
    items: DataFrame,
    keys: tuple[str, ...] = CUSTOMER_GRAIN,
    line_count: bool = False,
) -> DataFrame:
    """Item revenue per order grain. The customer grain drops NULL user/order/
    date rows; every grain drops NULL orders."""
    required = [k for k in ("user_id", "order_id", "order_date") if k in keys] if keys == CUSTOMER_GRAIN else ["order_id"]
    cond = None
    for k in required:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    aggs = [F.sum("item_gross_amount").alias("item_revenue")]
    if line_count:
        aggs.append(F.countDistinct("lineitem_id").alias("line_items_count"))
    return items.filter(cond).groupBy(*keys).agg(*aggs)


def order_revenue(
    items: DataFrame,
    options: DataFrame,
    keys: tuple[str, ...] = CUSTOMER_GRAIN,
    line_count: bool = False,
    with_discount: bool = False,
) -> DataFrame:
    """Orders at ``keys`` grain with item, option and total revenue (exact
    decimal). ``with_discount`` adds ``discount_amount`` and ``has_discount``
    (an order is discounted when its discount sum is below 0)."""
    joined = item_revenue(items, keys, line_count).join(option_revenue(options, with_discount), "order_id", "left")
    none = F.lit(0)
    option = F.coalesce("option_revenue", none)
    columns = {
        "option_revenue": option,
        "order_total_revenue": money_round(F.col("item_revenue") + option),
    }
    if with_discount:
        discount = F.coalesce("discount_amount", none)
        columns |= {"discount_amount": discount, "has_discount": discount < 0}
    return joined.withColumns(columns)


def customer_orders(store_orders: DataFrame) -> DataFrame:
    """Customer-grain orders rolled up from store-grain ones (J1-J3 without a
    second pass over the lines). The store grain refines the customer grain, and
    sums are exact, so item revenue adds up; an order's option revenue stands
    whole in each of its rows, so any of them has it."""
    required = [F.col(k).isNotNull() for k in CUSTOMER_GRAIN]
    rows = store_orders.filter(required[0] & required[1] & required[2])
    item, option = F.sum("item_revenue"), F.max("option_revenue")
    return rows.groupBy(*CUSTOMER_GRAIN).agg(
        item.alias("item_revenue"), option.alias("option_revenue"), money_round(item + option).alias("order_total_revenue")
    )


def daily_customer_revenue(orders: DataFrame) -> DataFrame:
    """Per (user, date): revenue and distinct orders, from customer-grain orders."""
    return orders.groupBy("user_id", "order_date").agg(
        F.sum("order_total_revenue").alias("daily_revenue"),
        F.countDistinct("order_id").alias("daily_order_count"),
    )
