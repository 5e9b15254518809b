"""Dashboard views (V1-V6) and their KPIs as Spark DataFrames over the gold
marts. Only the final, small result ever needs to leave the cluster.

Conventions kept from the dashboard: roll-ups by a label drop NULL labels
(pandas ``groupby`` semantics); KPI sums over an empty selection are 0 and
means are NULL; the top location of an empty selection is 'N/A'. Means of money
columns are computed in exact decimal (the columns hold cents) and rounded
half-up.

Note: ``order_count`` / ``customer_count`` summed over categories and periods
count an order or customer once per row they appear in (not additive).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.config import AT_RISK, INACTIVE
from ledgerline.operators.metrics import DISCOUNT, LOCATION, LOYALTY
from ledgerline.schemas import mart_columns

_CENTS = "decimal(20,2)"

GOLD_TABLES = ("customer_ltv_daily", "customer_segments", "sales_trends", "loyalty_location_discount")


def marts_from_catalog(spark: SparkSession, database: str = "ledgerline_gold") -> dict[str, DataFrame]:
    """The stored gold marts as registered by the pipeline (what the views
    read in production). A view's equality predicate on ``period_type`` /
    ``metric_type`` becomes a partition filter on these tables."""
    return {t: spark.table(f"{database}.{t}") for t in GOLD_TABLES}


def _cents(c: str) -> Column:
    return F.col(c).cast(_CENTS)


def _round_mean(c: str, as_cents: bool = True) -> Column:
    v = _cents(c) if as_cents else F.col(c).cast("decimal(20,0)")
    return F.round(F.avg(v), 2).cast("double")


def _sum_money(c: str) -> Column:
    return F.coalesce(F.round(F.sum(_cents(c)), 2), F.lit(0)).cast("double")


def _sum_count(c: str) -> Column:
    return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")


def _count_by(df: DataFrame, label: str) -> DataFrame:
    return df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("user_id").alias("customer_count"))


# ---------------------------------------------------------------- V1 segmentation

# Fixed: what the view shows.
SEGMENTATION_COLUMNS = [
    "user_id",
    "recency_days",
    "frequency_orders",
    "monetary_total_spend",
    "rfm_segment",
    "inactivity_tag",
    "clv_group",
    "customer_ltv_to_date",
]


def segmentation(segments: DataFrame, ltv_daily: DataFrame) -> DataFrame:
    """Segments with each customer's CLV group and latest running LTV."""
    ltv = ltv_daily.groupBy("user_id", "clv_group").agg(F.max("customer_ltv_to_date").alias("customer_ltv_to_date"))
    base = segments.select("user_id", "recency_days", "frequency_orders", "monetary_total_spend", "rfm_segment", "inactivity_tag")
    return base.join(ltv, on="user_id", how="left").select(*SEGMENTATION_COLUMNS)


def segment_counts(view: DataFrame) -> DataFrame:
    return _count_by(view, "rfm_segment")


def segmentation_kpis(view: DataFrame) -> DataFrame:
    return view.agg(
        F.count(F.lit(1)).alias("total_customers"),
        _round_mean("monetary_total_spend").alias("average_spend"),
        _round_mean("frequency_orders", as_cents=False).alias("average_frequency"),
    )


# ------------------------------------------------------------------- V2 churn

# Fixed: what the view shows.
CHURN_COLUMNS = [
    "user_id",
    "recency_days",
    "frequency_orders",
    "monetary_total_spend",
    "average_gap_between_orders_days",
    "last_30_day_spend",
    "previous_30_day_spend",
    "spend_change_pct",
    "rfm_segment",
    "inactivity_tag",
]
AT_RISK_TAGS = (AT_RISK, INACTIVE)


def churn(segments: DataFrame) -> DataFrame:
    return segments.select(*CHURN_COLUMNS)


def at_risk(view: DataFrame) -> DataFrame:
    return view.filter(F.col("inactivity_tag").isin(*AT_RISK_TAGS))


def risk_counts(view: DataFrame) -> DataFrame:
    return _count_by(view, "inactivity_tag")


def churn_kpis(view: DataFrame) -> DataFrame:
    return view.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.count(F.when(F.col("inactivity_tag").isin(*AT_RISK_TAGS), F.col("user_id"))).alias("at_risk_customers"),
        F.round(F.avg(F.col("recency_days").cast("decimal(20,0)")), 2).cast("double").alias("average_recency_days"),
    )


# ------------------------------------------------------------------- V3 sales

SALES_COLUMNS = mart_columns("sales_trends")


def sales(trends: DataFrame, period_type: str) -> DataFrame:
    """Equality predicate on the period type: with a stored mart partitioned
    by ``period_type`` this is a partition filter; on the live plan Catalyst
    prunes the other period branches."""
    return trends.filter(F.col("period_type") == F.lit(period_type)).select(*SALES_COLUMNS)


def sales_kpis(view: DataFrame) -> DataFrame:
    return view.agg(
        _sum_money("total_revenue").alias("total_revenue"),
        _sum_count("order_count").alias("total_orders"),
        _sum_count("customer_count").alias("total_customers"),
    )


def revenue_trend(view: DataFrame) -> DataFrame:
    return (
        view.filter(F.col("period_value").isNotNull())
        .groupBy("period_value")
        .agg(F.sum(_cents("total_revenue")).cast("double").alias("total_revenue"))
        .orderBy("period_value")
    )


def category_revenue(view: DataFrame) -> DataFrame:
    return (
        view.filter(F.col("item_category").isNotNull())
        .groupBy("item_category")
        .agg(F.sum(_cents("total_revenue")).cast("double").alias("total_revenue"))
        .orderBy("item_category")
    )


# ------------------------------------------------ V4-V6 loyalty / location / discount


def _metric_view(metrics: DataFrame, metric_type: str, label: str) -> DataFrame:
    return metrics.filter(F.col("metric_type") == F.lit(metric_type)).select(
        F.col("metric_dimension").alias(label),
        "currency",
        "total_revenue",
        "total_orders",
        "total_customers",
        "average_order_value",
    )


def _metric_kpis(view: DataFrame) -> DataFrame:
    return view.agg(
        _sum_money("total_revenue").alias("total_revenue"),
        _sum_count("total_orders").alias("total_orders"),
        _round_mean("average_order_value").alias("average_order_value"),
    )


def loyalty(metrics: DataFrame) -> DataFrame:
    return _metric_view(metrics, LOYALTY, "loyalty_status")


def loyalty_kpis(view: DataFrame) -> DataFrame:
    """Mean of the group means (unweighted), as the dashboard shows it."""
    return _metric_kpis(view)


def location(metrics: DataFrame) -> DataFrame:
    return _metric_view(metrics, LOCATION, "restaurant_id")


def location_ranking(view: DataFrame) -> DataFrame:
    """Revenue descending, NULL last; ties broken by restaurant and currency."""
    return view.orderBy(F.col("total_revenue").desc_nulls_last(), "restaurant_id", "currency")


def location_kpis(view: DataFrame) -> DataFrame:
    rank_key = F.struct(
        F.col("total_revenue").isNull(),
        -F.col("total_revenue"),
        F.col("restaurant_id"),
        F.col("currency"),
    )
    return view.agg(
        F.coalesce(F.min_by("restaurant_id", rank_key), F.lit("N/A")).alias("top_location"),
        F.round(F.max(_cents("total_revenue")), 2).cast("double").alias("highest_revenue"),
        _round_mean("average_order_value").alias("average_order_value"),
    )


def discount(metrics: DataFrame) -> DataFrame:
    return _metric_view(metrics, DISCOUNT, "discount_status")


def discount_kpis(view: DataFrame) -> DataFrame:
    return _metric_kpis(view)
