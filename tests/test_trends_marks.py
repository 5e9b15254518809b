"""Trends by marks of first lines: what a task holds, and the calendar's edges."""

import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerline.functions.columns import year_week_key
from ledgerline.operators import trends

_SCHEMA = (
    "order_date date, order_id string, user_id string, restaurant_id string, item_category string, currency string, "
    "item_gross_amount decimal(18,2)"
)


def _items(spark):
    """Lines on the days where a calendar year's first and last weeks have the same key, and around them."""
    rng = random.Random(9)
    edges = [dt.date(y, m, d) for y in (2020, 2021, 2022, 2024) for m, d in ((1, 1), (1, 2), (1, 3), (1, 6), (12, 28), (12, 30), (12, 31))]
    rows = [
        (
            rng.choice(edges), rng.choice(["", "o1", "o2", f"p{k}"]), rng.choice([None, "", "hot", "u2"]),
            rng.choice(["R1", None]), "pizza", "USD", rng.choice([None, Decimal(k) / 100]),
        )
        for k in range(1500)
    ]
    return spark.createDataFrame(rows, _SCHEMA)


def _plain(items, value):
    groups = items.groupBy(value.alias("v"), *trends.TREND_KEYS).agg(
        F.round(F.sum("item_gross_amount"), 2), F.countDistinct("order_id"), F.countDistinct("user_id")
    )
    return sorted(map(tuple, groups.collect()), key=str)


def test_weeks_at_the_ends_of_years(spark):
    items = _items(spark)
    for iso in (False, True):
        got = trends.sales_period(items, "weekly", iso).select("period_value", *trends.TREND_KEYS, "total_revenue", "order_count", "customer_count")
        assert sorted(map(tuple, got.collect()), key=str) == _plain(items, year_week_key("order_date", iso))
        months = trends.sales_trends(items, ("monthly",), iso_year=iso).drop("period_type")
        assert sorted(map(tuple, months.collect()), key=str) == _plain(items, F.date_format("order_date", "yyyy-MM"))


def test_tasks_hold_no_map_of_members(spark):
    """The only hash maps are those of the groups; orders and users pass through sorts, which spill."""
    items = _items(spark)
    for df in (trends.sales_trends(items), trends.sales_period(items, "monthly"), trends.sales_period(items, "weekly")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        maps = [x for x in plan.splitlines() if "HashAggregate" in x]
        assert len(maps) == 2 and not any("order_id" in x or "user_id" in x for x in maps)
