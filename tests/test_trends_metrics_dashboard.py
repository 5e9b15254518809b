import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import GOLDEN_AS_OF
from ledgerline.operators import metrics, trends
from ledgerline.plans import dashboard, marts


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_pizza_daily_row(golden):
    daily = trends.sales_period(golden["items"], "daily").collect()
    pizza = [r for r in daily if r.period_value == "2024-06-20" and r.item_category == "pizza"]
    assert len(pizza) == 1
    r = pizza[0]
    assert (r.restaurant_id, r.currency, r.total_revenue, r.order_count, r.customer_count) == (
        "R1",
        "USD",
        Decimal("42.00"),  # items only, no options (T10)
        1,
        1,
    )


def test_trend_plans_agree(golden):
    want = _rows(trends.sales_trends(golden["items"], method="union"))
    assert want == _rows(trends.sales_trends(golden["items"]))


def _plain_trends(items):
    """Distinct counts of each period by themselves."""
    out = []
    for p in trends.PERIOD_TYPES:
        value = trends._period_value(p).alias("period_value")
        groups = trends.trend_base(items).groupBy(value, *trends.TREND_KEYS).agg(
            F.round(F.sum("item_gross_amount"), 2), F.countDistinct("order_id"), F.countDistinct("user_id")
        )
        out += [(p, *r) for r in groups.collect()]
    return sorted(out, key=str)


def test_trends_equal_distinct_counts_of_each_period(spark):
    """Orders that span days and weeks, NULL users and keys, one user with a third of the lines, and the
    last days of December, whose key is that of the first week of the same year."""
    rng = random.Random(4)
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=d) for d in (*range(40), 363, 364, 365)]
    rows = [
        (
            rng.choice(days), f"o{rng.randrange(150)}", "hot" if k % 3 == 0 else rng.choice([None, "u1", "u2", "u3"]),
            rng.choice(["R1", None]), rng.choice(["pizza", "salad"]), "USD", Decimal(rng.randrange(-500, 5000)) / 100,
        )
        for k in range(900)
    ]
    schema = "order_date date, order_id string, user_id string, restaurant_id string, item_category string, currency string, item_gross_amount decimal(18,2)"
    items = spark.createDataFrame(rows + [(None, "o1", "u1", "R1", "x", "USD", None), (days[0], None, "u1", "R1", "x", "USD", None)], schema)
    assert sorted(map(tuple, trends.sales_trends(items).collect()), key=str) == _plain_trends(items)


def test_trends_move_each_member_twice(golden):
    """Two rows a line to the first aggregate; behind it only the placement and the small last aggregate shuffle."""
    plan = trends.sales_trends(golden["items"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 3 and "Expand" not in plan


def test_rollup_revenue_equal_over_periods(golden):
    t = trends.sales_trends(golden["items"]).groupBy("period_type").sum("total_revenue").collect()
    assert len({r[1] for r in t}) == 1


def test_trends_drop_null_dates_keep_null_users(golden):
    t = trends.sales_period(golden["items"], "daily").collect()
    assert sum(r.order_count for r in t if r.period_value == "2024-06-20") >= 2  # O1, O10, O11 (NULL user)
    assert all(r.period_value is not None for r in t)


def test_metric_plans_agree(golden):
    orders = marts.store_orders(golden["items"], golden["options"])
    assert _rows(metrics.loyalty_location_discount(orders, "union")) == _rows(
        metrics.loyalty_location_discount(orders, "stacked")
    )


def test_metrics_golden(golden):
    orders = marts.store_orders(golden["items"], golden["options"])
    disc = {r.metric_dimension: r for r in metrics.discount_effectiveness(orders).collect()}
    assert disc["discounted_orders"].total_orders == 1
    assert disc["discounted_orders"].total_discount_amount == Decimal("-5.00")
    loc = metrics.location_performance(orders).collect()
    assert [r.location_revenue_rank for r in loc] == [1]


def test_location_rank_puts_the_orders_together_once(spark):
    """The bounds, the counts and the result of the ranking read written metrics, not the orders again."""
    seen = spark.sparkContext.accumulator(0)

    def told(row):
        seen.add(1)
        return row

    money = [Decimal("5.00"), Decimal("5.00"), Decimal("7.50"), None, None, Decimal("-1.25")]
    rows = [(f"o{k}", f"R{k}", None if k == 2 else f"u{k}", "USD", m) for k, m in enumerate(money)]
    rows += [("o0", "R0", "u0", "USD", Decimal("0.00")), ("o9", None, "u9", None, Decimal("7.50"))]
    schema = "order_id string, restaurant_id string, user_id string, currency string, order_total_revenue decimal(18,2)"
    orders = spark.createDataFrame(spark.sparkContext.parallelize(rows, 2).map(told), schema)
    ranked = metrics.location_performance(orders).collect()
    assert seen.value == len(rows)
    found = {r.restaurant_id: (r.total_revenue, r.location_revenue_rank, r.total_orders, r.total_customers) for r in ranked}
    assert found == {
        None: (Decimal("7.50"), 1, 1, 1),
        "R2": (Decimal("7.50"), 1, 1, 0),
        "R0": (Decimal("5.00"), 2, 1, 1),
        "R1": (Decimal("5.00"), 2, 1, 1),
        "R5": (Decimal("-1.25"), 3, 1, 1),
        "R3": (None, 4, 1, 1),
        "R4": (None, 4, 1, 1),
    }


def test_null_and_false_loyalty_are_two_store_rows(spark):
    from conftest import ITEM_COLS, text_df
    from ledgerline.operators import silver

    rows = [
        (" a ", "R1", "2024-06-01", "O1", "U1", "1", None, "usd", "O1-1", "x", "y", "1.00", "1"),
        (" a ", "R1", "2024-06-01", "O1", "U1", "1", "false", "usd", "O1-2", "x", "y", "2.00", "1"),
    ]
    items = silver.order_items(text_df(spark, ITEM_COLS, rows))
    opts = silver.order_item_options(spark.createDataFrame([], "ORDER_ID string, LINEITEM_ID string, OPTION_GROUP_NAME string, OPTION_NAME string, OPTION_PRICE string, OPTION_QUANTITY string"))
    o = marts.store_orders(items, opts).collect()
    assert sorted(str(r.is_loyalty) for r in o) == ["False", "None"]
    loyalty = metrics.loyalty_impact(marts.store_orders(items, opts)).collect()
    assert len(loyalty) == 1 and loyalty[0].total_orders == 1  # distinct orders


@pytest.fixture(scope="module")
def gold(golden):
    return {
        "ltv": marts.customer_ltv_daily(golden["items"], golden["options"]),
        "seg": marts.customer_segments(golden["items"], golden["options"], GOLDEN_AS_OF),
        "trends": marts.sales_trends(golden["items"]),
        "metrics": marts.loyalty_location_discount(golden["items"], golden["options"]),
    }


def test_dashboard_segmentation(gold):
    view = dashboard.segmentation(gold["seg"], gold["ltv"])
    assert view.count() == 5
    u5 = [r for r in view.collect() if r.user_id == "U5"][0]
    assert (u5.clv_group, u5.customer_ltv_to_date) == ("high_clv", 600.0)
    k = dashboard.segmentation_kpis(view).first()
    assert (k.total_customers, k.average_spend, k.average_frequency) == (5, 142.65, 2.0)
    counts = {r.rfm_segment: r.customer_count for r in dashboard.segment_counts(view).collect()}
    assert counts == {"vip": 1, "new_customer": 2, "standard": 1, "churn_risk": 1}
    assert sum(counts.values()) == view.count()


def test_dashboard_churn(gold):
    view = dashboard.churn(gold["seg"])
    assert [r.user_id for r in dashboard.at_risk(view).collect()] == ["U3"]
    k = dashboard.churn_kpis(view).first()
    assert (k.total_customers, k.at_risk_customers, k.average_recency_days) == (5, 1, 43.4)


def test_dashboard_sales(gold):
    view = dashboard.sales(gold["trends"], "monthly")
    k = dashboard.sales_kpis(view).first()
    total_items = 21 + 4.25 + 21 + 2 + 10 + 20 + 5 + 30 + 600 + 7  # dated lines only
    assert k.total_revenue == pytest.approx(total_items)
    trend = dashboard.revenue_trend(view).collect()
    assert [r.period_value for r in trend] == sorted(r.period_value for r in trend)


def test_dashboard_location_and_empty(gold, spark):
    loc = dashboard.location(gold["metrics"])
    k = dashboard.location_kpis(loc).first()
    assert k.top_location == "R1"
    empty = loc.filter("1 = 0")
    e = dashboard.location_kpis(empty).first()
    assert (e.top_location, e.highest_revenue, e.average_order_value) == ("N/A", None, None)
    s = dashboard.sales_kpis(dashboard.sales(gold["trends"], "none")).first()
    assert (s.total_revenue, s.total_orders, s.total_customers) == (0.0, 0, 0)


def test_dashboard_loyalty_discount(gold):
    lk = dashboard.loyalty_kpis(dashboard.loyalty(gold["metrics"])).first()
    dk = dashboard.discount_kpis(dashboard.discount(gold["metrics"])).first()
    assert lk.total_revenue == dk.total_revenue  # both partition the same orders
    assert lk.total_orders == dk.total_orders


def test_week_label_rule(spark):
    from ledgerline.functions.columns import year_week_key

    df = spark.createDataFrame([(dt.date(2021, 1, 1),), (dt.date(2024, 12, 30),)], "order_date date")
    assert [r.w for r in df.select(year_week_key("order_date").alias("w")).collect()] == ["2021-W53", "2024-W01"]


def test_reconciliation_detects_inconsistent_marts(gold):
    from pyspark.sql import functions as F

    from ledgerline.plans import quality

    ok = {r.check: r.consistent for r in quality.reconciliation(_named(gold)).collect()}
    assert ok == {
        "customer_marts_total": True,
        "sales_trends_by_period_type": True,
        "loyalty_location_discount_by_metric_type": True,
    }
    broken = _named(gold)
    broken["customer_segments"] = broken["customer_segments"].filter(F.col("user_id") != "U5")
    broken["sales_trends"] = broken["sales_trends"].filter(F.col("period_type") != "daily").unionByName(
        broken["sales_trends"].filter((F.col("period_type") == "daily") & (F.col("item_category") != "pizza"))
    )
    bad = {r.check: r.consistent for r in quality.reconciliation(broken).collect()}
    assert bad["customer_marts_total"] is False
    assert bad["sales_trends_by_period_type"] is False
    assert bad["loyalty_location_discount_by_metric_type"] is True


def _named(gold):
    return {
        "customer_ltv_daily": gold["ltv"],
        "customer_segments": gold["seg"],
        "sales_trends": gold["trends"],
        "loyalty_location_discount": gold["metrics"],
    }
