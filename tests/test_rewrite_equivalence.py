"""Single-aggregate customer plans against a row-by-row computation."""

import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import customers
from ledgerline.sources import work
from tests.helpers.plain_windows import plain_ntile

AS_OF = dt.date(2024, 7, 1)


def _orders(spark, seed, n=1500):
    rnd = random.Random(seed)
    rows, seen = [], set()
    for k in range(n):
        user = "hot" if k % 3 == 0 else f"u{rnd.randrange(120)}"  # one user holds a third of the orders
        order = f"o{rnd.randrange(n)}"
        day = AS_OF - dt.timedelta(days=rnd.randrange(-10, 120))  # includes future orders
        if (user, order, day) in seen:
            continue
        seen.add((user, order, day))
        amount = Decimal(rnd.randrange(-500, 50000)) / 100
        rows.append((user, order, day, amount))
    return spark.createDataFrame(rows, "user_id string, order_id string, order_date date, order_total_revenue decimal(18,2)")


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _half_up(x, places=2):
    return x.quantize(Decimal(1).scaleb(-places), rounding=ROUND_HALF_UP)


def _by_user(orders):
    users = {}
    for u, o, d, a in (tuple(r) for r in orders.collect()):
        users.setdefault(u, []).append((d, o, a))
    return users


@pytest.mark.parametrize("seed", [1, 2])
def test_segments_equal_row_by_row(spark, seed):
    orders = _orders(spark, seed)
    got = {r["user_id"]: r for r in customers.customer_segments(orders, AS_OF).collect()}
    users = _by_user(orders)
    assert set(got) == set(users)
    for u, rows in users.items():
        days = sorted(d for d, _, _ in rows)
        gaps = [(b - a).days for a, b in zip(days, days[1:], strict=False)]
        ago = [((AS_OF - d).days, a) for d, _, a in rows]
        r = got[u]
        assert r["frequency_orders"] == len({o for _, o, _ in rows})
        assert r["monetary_total_spend"] == sum(a for _, _, a in rows)
        assert r["recency_days"] == (AS_OF - days[-1]).days
        gap = _half_up(Decimal(sum(gaps)) / len(gaps)) if gaps else None
        assert r["average_gap_between_orders_days"] == gap
        if min(n for n, _ in ago) > 60:
            assert r["last_30_day_spend"] is None and r["previous_30_day_spend"] is None
            continue
        last, previous = sum(a for n, a in ago if n <= 30), sum(a for n, a in ago if 30 < n <= 60)
        assert (r["last_30_day_spend"], r["previous_30_day_spend"]) == (last, previous)
        change = _half_up((last - previous) * 100 / Decimal(previous)) if previous else None
        assert r["spend_change_pct"] == change


@pytest.mark.parametrize("seed", [3, 4])
def test_gaps_and_windows_equal_row_by_row(spark, seed):
    orders = _orders(spark, seed)
    users = _by_user(orders)
    got = {(r["user_id"], r["order_id"], r["order_date"]): r["previous_order_date"] for r in customers.order_gaps(orders, 7).collect()}
    want = {}
    for u, rows in users.items():
        before = None
        for d, o, _ in sorted(rows):
            want[u, o, d] = before
            before = d
    assert got == want
    spend = {r["user_id"]: (r["last_30_day_spend"], r["previous_30_day_spend"]) for r in customers.spend_windows(orders, AS_OF).collect()}
    for u, rows in users.items():
        ago = [((AS_OF - d).days, a) for d, _, a in rows]
        if min(n for n, _ in ago) <= 60:
            assert spend[u] == (sum(a for n, a in ago if n <= 30), sum(a for n, a in ago if 30 < n <= 60))
        else:
            assert u not in spend


def test_today_is_the_default_date(spark):
    orders = _orders(spark, 5)
    today = spark.sql("SELECT current_date()").first()[0]
    assert _rows(customers.customer_segments(orders)) == _rows(customers.customer_segments(orders, today))


def test_clv_distributed_equals_plain(spark):
    o = _orders(spark, 7)
    from ledgerline.operators import revenue

    daily = revenue.daily_customer_revenue(o)
    got = customers.clv_groups(daily, num_parts=7)
    totals = daily.groupBy("user_id").agg(F.sum("daily_revenue").alias("total_ltv"))
    want = plain_ntile(totals, 5, [("total_ltv", False), ("user_id", True)], "clv_rank_bucket")
    assert _rows(got.drop("clv_group")) == _rows(want)


def test_daily_rows_are_placed_by_user_once(spark):
    """Totals, window and join read the placement; in the join only the groups move."""
    from ledgerline.operators import revenue

    daily = revenue.daily_customer_revenue(_orders(spark, 8))
    out = customers.customer_ltv_daily(daily)
    plan = out._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning(user_id" in line]
    assert len(moved) <= 1, plan  # the side of the groups
    running = customers.running_ltv(work.placed(daily, "user_id"))
    assert "Exchange" not in running._jdf.queryExecution().executedPlan().toString()
    totals = work.placed(daily, "user_id").groupBy("user_id").agg(F.sum("daily_revenue"))
    assert "Exchange" not in totals._jdf.queryExecution().executedPlan().toString()
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("ledgerline_work")]
    want = customers.running_ltv(daily).join(customers.clv_groups(daily).select("user_id", "clv_group"), "user_id")
    assert _rows(out) == _rows(want.select(*out.columns))
