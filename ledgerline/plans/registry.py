"""Registered queries: each is ``(spark, sf_dir) -> DataFrame`` over the whole
testdata tables (bronze-shaped by ``sources.testdata``), cleaned by the silver
operators and run through the same operators a production pipeline uses.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.config import TESTDATA_AS_OF
from ledgerline.functions.columns import money_to_double as _dbl
from ledgerline.operators import customers, metrics, revenue, silver, trends
from ledgerline.plans import dashboard, marts, quality
from ledgerline.sources import catalog, ingest, testdata
from ledgerline.sources.work import materialize, placed


@dataclass
class Inputs:
    spark: SparkSession
    sf_dir: str

    @cached_property
    def bronze_items(self) -> DataFrame:
        return testdata.bronze_order_items(self.spark, self.sf_dir)

    @cached_property
    def bronze_options(self) -> DataFrame:
        return testdata.bronze_order_item_options(self.spark, self.sf_dir)

    @cached_property
    def bronze_dates(self) -> DataFrame:
        return testdata.bronze_date_dim(self.spark, self.sf_dir)

    @cached_property
    def items(self) -> DataFrame:
        return silver.order_items(self.bronze_items)

    @cached_property
    def options(self) -> DataFrame:
        return silver.order_item_options(self.bronze_options)

    @cached_property
    def dates(self) -> DataFrame:
        return silver.date_dim(self.bronze_dates)

    @cached_property
    def customer_orders(self) -> DataFrame:
        return marts.customer_orders(self.items, self.options)

    @cached_property
    def store_orders(self) -> DataFrame:
        return marts.store_orders(self.items, self.options)

    @cached_property
    def daily(self) -> DataFrame:
        return revenue.daily_customer_revenue(self.customer_orders)

    @cached_property
    def ltv_mart(self) -> DataFrame:
        return marts.customer_ltv_daily(self.items, self.options)

    @cached_property
    def segments_mart(self) -> DataFrame:
        return marts.customer_segments(self.items, self.options, TESTDATA_AS_OF)

    @cached_property
    def trends_mart(self) -> DataFrame:
        return marts.sales_trends(self.items)

    @cached_property
    def trends_for_views(self) -> DataFrame:
        # Views filter one period type: the union form lets Catalyst prune the
        # other periods (the stored mart is partitioned by period_type).
        return marts.sales_trends(self.items, method="union")

    @cached_property
    def metrics_mart(self) -> DataFrame:
        return marts.loyalty_location_discount(self.items, self.options)

    @cached_property
    def metrics_for_views(self) -> DataFrame:
        # Dashboard views filter one metric type: on the union form Catalyst
        # prunes the other two families (the stored mart is partitioned by
        # metric_type for the same effect).
        return marts.loyalty_location_discount(self.items, self.options, method="union")


QueryFn = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Callable[[Inputs], DataFrame]] = {}


def register(name: str):
    def deco(fn: Callable[[Inputs], DataFrame]):
        _REGISTRY[name] = fn
        return fn

    return deco


# ------------------------------------------------------------------ bronze/silver


@register("bronze_audit")
def _bronze_audit(i: Inputs) -> DataFrame:
    # audit timestamp left out of the compared output (non-deterministic)
    return ingest.add_audit(i.bronze_items, "dbo.order_items", timestamp=False)


@register("silver_order_items")
def _silver_items(i: Inputs) -> DataFrame:
    df = i.items.withColumn("creation_timestamp_utc", F.date_format("creation_timestamp_utc", "yyyy-MM-dd HH:mm:ss"))
    return _dbl(df, ["item_price", "item_gross_amount"])


@register("silver_order_item_options")
def _silver_options(i: Inputs) -> DataFrame:
    return _dbl(i.options, ["option_price", "option_gross_amount"])


@register("silver_date_dim")
def _silver_dates(i: Inputs) -> DataFrame:
    return i.dates


# ------------------------------------------------------------------ revenue core


@register("option_revenue")
def _option_revenue(i: Inputs) -> DataFrame:
    return _dbl(revenue.option_revenue(i.options, with_discount=True), ["option_revenue", "discount_amount"])


@register("order_revenue")
def _order_revenue(i: Inputs) -> DataFrame:
    df = revenue.order_revenue(i.items, i.options, revenue.CUSTOMER_GRAIN, line_count=True)
    return _dbl(df, ["item_revenue", "option_revenue", "order_total_revenue"])


@register("order_revenue_seven_key")
def _order_revenue7(i: Inputs) -> DataFrame:
    return _dbl(
        i.store_orders, ["item_revenue", "option_revenue", "order_total_revenue", "discount_amount"]
    )


@register("daily_customer_revenue")
def _daily(i: Inputs) -> DataFrame:
    return _dbl(i.daily, ["daily_revenue"])


# ------------------------------------------------------------------ M1 LTV


@register("running_ltv")
def _running_ltv(i: Inputs) -> DataFrame:
    return _dbl(customers.running_ltv(i.daily), ["daily_revenue", "customer_ltv_to_date"])


@register("clv_groups")
def _clv_groups(i: Inputs) -> DataFrame:
    return _dbl(customers.clv_groups(i.daily), ["total_ltv"])


@register("customer_ltv_daily")
def _ltv(i: Inputs) -> DataFrame:
    return i.ltv_mart


# ------------------------------------------------------------------ M2 segments


@register("rfm_base")
def _rfm(i: Inputs) -> DataFrame:
    return _dbl(customers.rfm_base(i.customer_orders, TESTDATA_AS_OF), ["monetary_total_spend"])


@register("order_gaps")
def _gaps(i: Inputs) -> DataFrame:
    return customers.order_gaps(i.customer_orders)


@register("average_order_gap")
def _avg_gap(i: Inputs) -> DataFrame:
    return _dbl(customers.average_order_gap(i.customer_orders), ["average_gap_between_orders_days"])


@register("spend_windows")
def _spend(i: Inputs) -> DataFrame:
    return _dbl(
        customers.spend_windows(i.customer_orders, TESTDATA_AS_OF),
        ["last_30_day_spend", "previous_30_day_spend", "spend_change_pct"],
    )


@register("customer_segments")
def _segments(i: Inputs) -> DataFrame:
    return i.segments_mart


# ------------------------------------------------------------------ M3 trends


def _period(p: str) -> Callable[[Inputs], DataFrame]:
    return lambda i: _dbl(trends.sales_period(i.items, p), ["total_revenue"])


register("sales_daily")(_period("daily"))
register("sales_weekly")(_period("weekly"))
register("sales_monthly")(_period("monthly"))


@register("sales_trends")
def _trends(i: Inputs) -> DataFrame:
    return i.trends_mart


# ------------------------------------------------------------------ M4 metrics

_METRIC_MONEY = ["total_revenue", "average_order_value", "total_discount_amount"]


@register("loyalty_impact")
def _loyalty(i: Inputs) -> DataFrame:
    return _dbl(metrics.loyalty_impact(i.store_orders), _METRIC_MONEY)


@register("location_performance")
def _location(i: Inputs) -> DataFrame:
    return _dbl(metrics.location_performance(i.store_orders), _METRIC_MONEY)


@register("discount_effectiveness")
def _discount(i: Inputs) -> DataFrame:
    return _dbl(metrics.discount_effectiveness(i.store_orders), _METRIC_MONEY)


@register("loyalty_location_discount")
def _metrics_mart(i: Inputs) -> DataFrame:
    return i.metrics_mart


@register("loyalty_repeat")
def _loyalty_repeat(i: Inputs) -> DataFrame:
    return metrics.loyalty_repeat(i.store_orders)


@register("seasonality")
def _seasonality(i: Inputs) -> DataFrame:
    return _dbl(trends.seasonality(i.items, i.dates), ["total_revenue"])


# ------------------------------------------------------------------ dashboards


@register("dash_segmentation")
def _d_seg(i: Inputs) -> DataFrame:
    return dashboard.segmentation(i.segments_mart, i.ltv_mart)


@register("dash_segment_counts")
def _d_seg_counts(i: Inputs) -> DataFrame:
    return dashboard.segment_counts(dashboard.segmentation(i.segments_mart, i.ltv_mart))


@register("dash_segmentation_kpis")
def _d_seg_kpis(i: Inputs) -> DataFrame:
    return dashboard.segmentation_kpis(dashboard.segmentation(i.segments_mart, i.ltv_mart))


@register("dash_churn")
def _d_churn(i: Inputs) -> DataFrame:
    return dashboard.churn(i.segments_mart)


@register("dash_risk_counts")
def _d_risk(i: Inputs) -> DataFrame:
    return dashboard.risk_counts(dashboard.churn(i.segments_mart))


@register("dash_at_risk")
def _d_at_risk(i: Inputs) -> DataFrame:
    return dashboard.at_risk(dashboard.churn(i.segments_mart))


@register("dash_churn_kpis")
def _d_churn_kpis(i: Inputs) -> DataFrame:
    return dashboard.churn_kpis(dashboard.churn(i.segments_mart))


@register("dash_sales_weekly")
def _d_sales(i: Inputs) -> DataFrame:
    return dashboard.sales(i.trends_for_views, "weekly")


@register("mart_sql_sales_monthly")
def _mart_sql(i: Inputs) -> DataFrame:
    """SQL text with a bound value over a temp view of the live mart."""
    i.trends_for_views.createOrReplaceTempView("sales_trends_live")
    columns = ", ".join(dashboard.SALES_COLUMNS)
    return catalog.mart_query(
        i.spark, f"SELECT {columns} FROM sales_trends_live WHERE period_type = :period", {"period": "monthly"}
    )


@register("dash_revenue_trend")
def _d_trend(i: Inputs) -> DataFrame:
    return dashboard.revenue_trend(dashboard.sales(i.trends_for_views, "monthly"))


@register("dash_category_revenue")
def _d_cat(i: Inputs) -> DataFrame:
    return dashboard.category_revenue(dashboard.sales(i.trends_for_views, "daily"))


@register("dash_sales_kpis")
def _d_sales_kpis(i: Inputs) -> DataFrame:
    return dashboard.sales_kpis(dashboard.sales(i.trends_for_views, "daily"))


@register("dash_loyalty")
def _d_loyalty(i: Inputs) -> DataFrame:
    return dashboard.loyalty(i.metrics_for_views)


@register("dash_loyalty_kpis")
def _d_loyalty_kpis(i: Inputs) -> DataFrame:
    return dashboard.loyalty_kpis(dashboard.loyalty(i.metrics_for_views))


@register("dash_location_ranking")
def _d_loc(i: Inputs) -> DataFrame:
    return dashboard.location_ranking(dashboard.location(i.metrics_for_views))


@register("dash_location_kpis")
def _d_loc_kpis(i: Inputs) -> DataFrame:
    return dashboard.location_kpis(dashboard.location(i.metrics_for_views))


@register("dash_discount")
def _d_disc(i: Inputs) -> DataFrame:
    return dashboard.discount(i.metrics_for_views)


@register("dash_discount_kpis")
def _d_disc_kpis(i: Inputs) -> DataFrame:
    return dashboard.discount_kpis(dashboard.discount(i.metrics_for_views))


# ------------------------------------------------------------------ quality


@register("quality_layer_checks")
def _quality(i: Inputs) -> DataFrame:
    """The checks of a run's tables. As in a run, what several tables come from is
    written once: the lines' columns that marts read, placed by order, and the
    orders at both grains."""
    columns = (*revenue.STORE_GRAIN, "item_category", "item_gross_amount")
    items = placed(i.items.select(*columns), "order_id")
    store_orders = materialize(marts.store_orders(items, i.options), "store-orders")
    orders = materialize(revenue.customer_orders(store_orders), "customer-orders")
    return quality.layer_checks(
        {
            "bronze.order_items": i.bronze_items,
            "silver.order_items": items,
            "silver.order_item_options": i.options,
            "silver.date_dim": i.dates,
        },
        {
            "gold.customer_ltv_daily": marts.customer_ltv_daily(items, i.options, orders=orders),
            "gold.customer_segments": marts.customer_segments(items, i.options, TESTDATA_AS_OF, orders=orders),
            "gold.sales_trends": marts.sales_trends(items),
            "gold.loyalty_location_discount": marts.loyalty_location_discount(items, i.options, orders=store_orders),
        },
    )


def queries() -> dict[str, QueryFn]:
    def bind(fn: Callable[[Inputs], DataFrame]) -> QueryFn:
        return lambda spark, sf_dir: fn(Inputs(spark, sf_dir))

    return {name: bind(fn) for name, fn in _REGISTRY.items()}
