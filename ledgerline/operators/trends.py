"""Sales trends: revenue, distinct orders and distinct customers per
(period, restaurant, category, currency) for daily, weekly and monthly periods.

Item revenue only (options are not included, unlike the other marts). Rows with
a NULL order or date are dropped; NULL users are kept (the distinct customer
count ignores them). The weekly key joins the calendar year to the ISO week.

Distinct orders and users can't be added up from days to weeks. A line therefore
says for its order, and then for its user, whether it is the first of the day, week
and month within (keys, order) and (keys, user): these marks add up. Lines move
once to their orders and once to their users, each time as one row that a task
sorts by member and day (sorts spill; no map of members is held). Only the last
aggregate, over lines that became rows per period, has a hash map, of the task's
groups. A hot group is spread over its members. A member's lines are split by
calendar year, in which days, months and weeks (calendar year and ISO week) lie
whole, and lines without a user by order.

``method="union"`` gives each period its own plan: a filter on one period type
prunes the others, so dashboard views over the live plan use it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.config import DAILY, MONTHLY, WEEKLY
from ledgerline.functions.columns import AMOUNT, money_round, year_month_key, year_week_key
from ledgerline.schemas import mart_columns

PERIOD_TYPES = (DAILY, WEEKLY, MONTHLY)
TREND_KEYS = ["restaurant_id", "item_category", "currency"]
TREND_COLUMNS = mart_columns("sales_trends")


def _period_value(period_type: str, iso_year: bool = False, day: Column | None = None):
    d = F.col("order_date") if day is None else day
    if period_type == DAILY:
        return d.cast("string")
    if period_type == WEEKLY:
        return year_week_key(d, iso_year)
    if period_type == MONTHLY:
        return year_month_key(d)
    raise ValueError(f"unknown period type {period_type!r}")


def trend_base(items: DataFrame) -> DataFrame:
    return items.filter(F.col("order_id").isNotNull() & F.col("order_date").isNotNull()).select(
        "order_date", "order_id", "user_id", *TREND_KEYS, "item_gross_amount"
    )


def _firsts(lines: DataFrame, member: list[str], period_types: tuple[str, ...], iso_year: bool, mark: str) -> DataFrame:
    """Adds ``<mark>_<period type>``: whether the line is the first of its period within ``member`` and the keys.

    By day, equal days and months stand together, and so do weeks, but for a calendar
    year's last days in ISO week 1 and its first ones in week 52 or 53: a key met
    again in December stood on a day of January before."""
    day = F.col("order_date")
    by_day = Window.partitionBy(*member, *TREND_KEYS).orderBy("order_date")
    before = by_day.rowsBetween(Window.unboundedPreceding, -1)
    met = {"_last": F.lag(day).over(by_day)}
    if WEEKLY in period_types:
        january, week = F.month(day) == 1, F.weekofyear(day)
        met |= {
            "_week_1": F.max(F.when(january & (week == 1), day)).over(before),
            "_week_52": F.max(F.when(january & (week >= 52), day)).over(before),
        }

    def first(period_type: str) -> Column:
        value = _period_value(period_type, iso_year)
        earlier = met if period_type == WEEKLY else ["_last"]
        same = [F.coalesce(_period_value(period_type, iso_year, F.col(c)) == value, F.lit(False)) for c in earlier]
        return ~reduce(Column.__or__, same)

    return lines.withColumns(met).withColumns({f"{mark}_{p}": first(p) for p in period_types}).drop(*met)


def _marked(items: DataFrame, period_types: tuple[str, ...], iso_year: bool) -> DataFrame:
    """Lines with the marks of their orders (``o_``) and users (``u_``)."""
    lines = trend_base(items).withColumn("guest", F.when(F.col("user_id").isNull(), F.xxhash64("order_id")))
    span = []
    if not iso_year:  # an ISO year's weeks cross calendar years
        lines, span = lines.withColumn("year", F.year("order_date")), ["year"]
    lines = _firsts(lines, ["order_id", *span], period_types, iso_year, "o").drop("order_id")
    return _firsts(lines, ["user_id", "guest", *span], period_types, iso_year, "u")


def _marks(period_type: str) -> tuple[Column, Column]:
    return F.col(f"o_{period_type}").alias("new_order"), (F.col(f"u_{period_type}") & F.col("user_id").isNotNull()).alias("new_user")


def _measures_of(rows: DataFrame, *periods: str) -> DataFrame:
    return rows.groupBy(*periods, *TREND_KEYS).agg(
        money_round(F.sum("item_gross_amount")).alias("total_revenue"),
        F.count_if("new_order").alias("order_count"),
        F.count_if("new_user").alias("customer_count"),
    )


def sales_period(items: DataFrame, period_type: str, iso_year: bool = False) -> DataFrame:
    """One period type."""
    value = _period_value(period_type, iso_year).alias("period_value")
    rows = _marked(items, (period_type,), iso_year).select(*TREND_KEYS, "item_gross_amount", value, *_marks(period_type))
    return _measures_of(rows, "period_value").withColumn("period_type", F.lit(period_type)).select(*TREND_COLUMNS)


def sales_trends(
    items: DataFrame,
    period_types: tuple[str, ...] = PERIOD_TYPES,
    method: str = "levels",
    iso_year: bool = False,
) -> DataFrame:
    """M3: the union of the period rollups."""
    if method == "union":
        return reduce(DataFrame.unionByName, (sales_period(items, p, iso_year) for p in period_types))
    periods = F.array(
        *(F.struct(F.lit(p).alias("period_type"), _period_value(p, iso_year).alias("period_value"), *_marks(p)) for p in period_types)
    )
    rows = _marked(items, period_types, iso_year).select(*TREND_KEYS, "item_gross_amount", F.inline(periods))
    return _measures_of(rows, "period_type", "period_value").select(*TREND_COLUMNS)


ORDER, USER, DAY = "o", "u", "d"


def _members(lines: DataFrame, keys: list[str], kinds: tuple[str, ...] = (ORDER, USER)) -> DataFrame:
    """One row per (day, keys, member): kind, id and, for orders, the amount of its lines."""
    ids = {ORDER: F.col("order_id"), USER: F.col("user_id"), DAY: F.col("order_date").cast("string")}
    amount = F.col("item_gross_amount")
    rows = F.array(
        *(
            F.struct(
                F.lit(k).alias("kind"), ids[k].alias("id"), (amount if k == ORDER else F.lit(None).cast(AMOUNT)).alias("amount")
            )
            for k in kinds
        )
    )
    each = lines.select("order_date", *keys, F.inline(rows)).filter(F.col("id").isNotNull())
    return each.groupBy("order_date", *keys, "kind", "id").agg(F.sum("amount").alias("amount"))


def _count(kind: str):
    return F.count(F.when(F.col("kind") == kind, F.lit(1)))


def _measures():
    return [
        money_round(F.sum("amount")).alias("total_revenue"),
        _count(ORDER).alias("order_count"),
        _count(USER).alias("customer_count"),
    ]


SEASON_KEYS = ["day_of_week", "day_type", "is_holiday", "currency"]


def seasonality(items: DataFrame, dates: DataFrame) -> DataFrame:
    """Item revenue, distinct orders and customers, and the number of distinct
    selling days by calendar attributes (weekday, weekday/weekend, holiday) and
    currency, from the silver calendar that the source builds but no mart
    reads.

    Left join on the order date, so revenue on dates missing from the calendar
    is kept under NULL attributes instead of being dropped. Members (orders,
    users, days) per day and currency are joined, not lines. The calendar has at
    most one row per day, so Spark's size check broadcasts it.
    """
    cal = dates.select(F.col("date_key").alias("order_date"), "day_of_week", "day_type", "is_holiday")
    members = _members(trend_base(items), ["currency"], (ORDER, USER, DAY)).join(cal, on="order_date", how="left")
    seasons_of_members = members.groupBy(*SEASON_KEYS, "kind", "id").agg(F.sum("amount").alias("amount"))
    return seasons_of_members.groupBy(*SEASON_KEYS).agg(*_measures(), _count(DAY).alias("selling_days"))
