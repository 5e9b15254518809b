"""Independent DuckDB SQL for every registered query.

Written from the business rules (not from the Spark code): the same
source-shaped views over the testdata tables, the same cleaning rules, and
exact arithmetic. Money stays DECIMAL; rounded means are computed in integer
units with explicit half-up rounding, and every output money column is cast
to DOUBLE at the end, as in the Spark queries. Counts are cast to BIGINT, day
differences and buckets to INTEGER.
"""

from __future__ import annotations

AS_OF = "DATE '2001-08-01'"


def _label(expr: str) -> str:
    t = f"trim({expr})"
    return f"CASE WHEN {t} IS NULL OR {t} = '' THEN 'unknown' ELSE lower({t}) END"


def _int(expr: str, to: str = "INTEGER") -> str:
    # sign, digits, an optional fraction that is cut off; other text or out of range -> NULL
    t = f"trim({expr})"
    return (
        f"CASE WHEN regexp_full_match({t}, '[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)') "
        f"THEN TRY_CAST(regexp_replace(regexp_extract({t}, '^[+-]?[0-9]*'), '^[+-]?$', '0') AS {to}) END"
    )


def _price(expr: str) -> str:
    # what a cast to double takes and is finite, as an exact decimal
    t = f"regexp_replace(trim({expr}), '[dDfF]$', '')"
    return f"CASE WHEN isfinite(TRY_CAST({t} AS DOUBLE)) THEN CAST({t} AS DECIMAL(27,10)) END"


def _half_up_mean(sum_units: str, n: str, decimals: int) -> str:
    """round(mean, 2) half-up (away from zero) from an exact integer sum of
    values scaled by 10^decimals."""
    k = 10**decimals
    return (
        f"(CASE WHEN ({n}) = 0 THEN NULL "
        f"WHEN ({sum_units}) >= 0 THEN ((200 * ({sum_units}) + ({n}) * {k}) // (2 * ({n}) * {k})) / 100.0 "
        f"ELSE -((200 * (-({sum_units})) + ({n}) * {k}) // (2 * ({n}) * {k})) / 100.0 END)"
    )


def _cents(expr: str) -> str:
    return f"CAST(({expr}) * 100 AS HUGEINT)"


def _money_mean(col: str) -> str:
    """Half-up 2-decimal mean of a cent-valued column (decimal or double)."""
    c = f"CAST({col} AS DECIMAL(20,2))"
    return _half_up_mean(f"sum({_cents(c)})", f"count({col})", 2)


_BASE = f"""
b_items AS (
  SELECT
    ' ' || CASE WHEN l.l_returnflag = 'A' THEN 'mobile' ELSE 'web' END || ' ' AS "APP_NAME",
    n.n_name AS "RESTAURANT_ID",
    CASE WHEN l.l_orderkey % 211 = 0 THEN 'not-a-date' ELSE CAST(o.o_orderdate AS VARCHAR) END AS "CREATION_TIME_UTC",
    CAST(l.l_orderkey AS VARCHAR) AS "ORDER_ID",
    CASE WHEN l.l_orderkey % 101 = 0 THEN NULL ELSE CAST(o.o_custkey AS VARCHAR) END AS "USER_ID",
    CAST(4000000000000000 + o.o_custkey AS VARCHAR) AS "PRINTED_CARD_NUMBER",
    CASE WHEN c.c_mktsegment IN ('BUILDING', 'AUTOMOBILE') THEN 'true'
         WHEN c.c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE 'false' END AS "IS_LOYALTY",
    CASE r.r_name WHEN 'AMERICA' THEN ' usd ' WHEN 'EUROPE' THEN ' eur ' WHEN 'ASIA' THEN ' jpy '
                  WHEN 'AFRICA' THEN ' zar ' ELSE ' aed ' END AS "CURRENCY",
    CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS "LINEITEM_ID",
    CASE WHEN p.p_partkey % 17 = 0 THEN NULL WHEN p.p_partkey % 19 = 0 THEN '   '
         ELSE ' ' || p.p_type || ' ' END AS "ITEM_CATEGORY",
    upper(p.p_name) AS "ITEM_NAME",
    CASE WHEN (l.l_orderkey + l.l_linenumber) % 89 = 0 THEN 'n/a'
         ELSE CAST(CAST(p.p_retailprice AS DECIMAL(18,2)) AS VARCHAR) END AS "ITEM_PRICE",
    CASE WHEN (l.l_orderkey + l.l_linenumber) % 83 = 0 THEN NULL
         ELSE CAST(CAST(trunc(l.l_quantity) AS INTEGER) AS VARCHAR) END AS "ITEM_QUANTITY"
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN part p ON l.l_partkey = p.p_partkey
),
b_options AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS "ORDER_ID",
         CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS "LINEITEM_ID",
         CASE WHEN l_linenumber = 7 THEN '  ' ELSE ' Extras ' END AS "OPTION_GROUP_NAME",
         CASE WHEN l_returnflag = 'R' THEN NULL ELSE 'Side Dish' END AS "OPTION_NAME",
         CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)), 2) AS VARCHAR) AS "OPTION_PRICE",
         '1' AS "OPTION_QUANTITY"
  FROM lineitem WHERE l_tax > 0
  UNION ALL
  SELECT CAST(l_orderkey AS VARCHAR),
         CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR),
         'Discounts', 'Promo',
         CASE WHEN l_orderkey % 97 = 0 THEN 'bad'
              ELSE CAST(-round(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)), 2) AS VARCHAR) END,
         '1'
  FROM lineitem WHERE l_discount >= 0.09
),
b_days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders),
b_dates AS (
  SELECT CASE WHEN day(d) = 13 THEN 'bad-key' ELSE strftime(d, '%Y-%m-%d') END AS date_key,
         CAST(year(d) AS VARCHAR) AS year, CAST(month(d) AS VARCHAR) AS month,
         CAST(weekofyear(d) AS VARCHAR) AS week,
         CASE dayofweek(d) WHEN 0 THEN ' Sunday' WHEN 1 THEN 'MONDAY ' WHEN 2 THEN 'Tuesday'
              WHEN 3 THEN ' wednesday ' WHEN 4 THEN 'Thursday' WHEN 5 THEN 'Friday' ELSE 'SATURDAY' END AS day_of_week,
         CASE WHEN day(d) = 14 THEN NULL WHEN dayofweek(d) IN (0, 6) THEN 'true' ELSE 'false' END AS is_weekend,
         CASE WHEN (month(d) = 1 AND day(d) = 1) OR (month(d) = 12 AND day(d) = 25) THEN 'true' ELSE 'false' END AS is_holiday,
         CASE WHEN month(d) = 1 AND day(d) = 1 THEN ' New Year '
              WHEN month(d) = 12 AND day(d) = 25 THEN 'Christmas' END AS holiday_name
  FROM b_days
),
s_items0 AS (
  SELECT trim("APP_NAME") AS app_name, trim("RESTAURANT_ID") AS restaurant_id,
         trim("CREATION_TIME_UTC") AS creation_time_utc_raw, trim("ORDER_ID") AS order_id,
         trim("USER_ID") AS user_id,
         {_int('"PRINTED_CARD_NUMBER"', 'BIGINT')} AS printed_card_number,
         TRY_CAST("IS_LOYALTY" AS BOOLEAN) AS is_loyalty,
         upper(trim("CURRENCY")) AS currency, trim("LINEITEM_ID") AS lineitem_id,
         {_label('"ITEM_CATEGORY"')} AS item_category,
         {_label('"ITEM_NAME"')} AS item_name,
         {_price('"ITEM_PRICE"')} AS item_price,
         {_int('"ITEM_QUANTITY"')} AS item_quantity
  FROM b_items
),
s_items AS (
  SELECT *, TRY_CAST(creation_time_utc_raw AS TIMESTAMP) AS creation_timestamp_utc,
         CAST(TRY_CAST(creation_time_utc_raw AS TIMESTAMP) AS DATE) AS order_date,
         CASE WHEN is_loyalty THEN 'loyalty' ELSE 'non_loyalty' END AS loyalty_status,
         CAST(round(item_price * item_quantity, 2) AS DECIMAL(18,2)) AS item_gross_amount
  FROM s_items0
  WHERE order_id IS NOT NULL AND lineitem_id IS NOT NULL AND item_price IS NOT NULL AND item_quantity IS NOT NULL
),
s_options AS (
  SELECT *, CAST(round(option_price * option_quantity, 2) AS DECIMAL(18,2)) AS option_gross_amount FROM (
    SELECT trim("ORDER_ID") AS order_id, trim("LINEITEM_ID") AS lineitem_id,
           {_label('"OPTION_GROUP_NAME"')} AS option_group_name,
           {_label('"OPTION_NAME"')} AS option_name,
           {_price('"OPTION_PRICE"')} AS option_price,
           {_int('"OPTION_QUANTITY"')} AS option_quantity
    FROM b_options)
  WHERE order_id IS NOT NULL AND lineitem_id IS NOT NULL AND option_price IS NOT NULL AND option_quantity IS NOT NULL
),
s_dates AS (
  SELECT *, CASE WHEN is_weekend THEN 'weekend' ELSE 'weekday' END AS day_type FROM (
    SELECT TRY_CAST(date_key AS DATE) AS date_key,
           {_int('year')} AS year, {_int('month')} AS month, {_int('week')} AS week,
           lower(trim(day_of_week)) AS day_of_week,
           TRY_CAST(is_weekend AS BOOLEAN) AS is_weekend,
           TRY_CAST(is_holiday AS BOOLEAN) AS is_holiday,
           trim(holiday_name) AS holiday_name
    FROM b_dates)
  WHERE date_key IS NOT NULL
),
opt_rev AS (
  SELECT order_id, sum(option_gross_amount) AS option_revenue,
         sum(CASE WHEN option_price < 0 THEN option_gross_amount ELSE 0 END) AS discount_amount
  FROM s_options WHERE order_id IS NOT NULL GROUP BY order_id
),
item3 AS (
  SELECT user_id, order_id, order_date, sum(item_gross_amount) AS item_revenue,
         count(DISTINCT lineitem_id) AS line_items_count
  FROM s_items WHERE user_id IS NOT NULL AND order_id IS NOT NULL AND order_date IS NOT NULL
  GROUP BY user_id, order_id, order_date
),
orders3 AS (
  SELECT i.user_id, i.order_id, i.order_date, i.item_revenue, i.line_items_count,
         coalesce(o.option_revenue, 0) AS option_revenue,
         round(i.item_revenue + coalesce(o.option_revenue, 0), 2) AS order_total_revenue
  FROM item3 i LEFT JOIN opt_rev o ON i.order_id = o.order_id
),
item7 AS (
  SELECT order_id, restaurant_id, user_id, is_loyalty, loyalty_status, order_date, currency,
         sum(item_gross_amount) AS item_revenue
  FROM s_items WHERE order_id IS NOT NULL
  GROUP BY order_id, restaurant_id, user_id, is_loyalty, loyalty_status, order_date, currency
),
orders7 AS (
  SELECT i.*, coalesce(o.option_revenue, 0) AS option_revenue,
         coalesce(o.discount_amount, 0) AS discount_amount,
         round(i.item_revenue + coalesce(o.option_revenue, 0), 2) AS order_total_revenue,
         coalesce(o.discount_amount, 0) < 0 AS has_discount
  FROM item7 i LEFT JOIN opt_rev o ON i.order_id = o.order_id
),
daily AS (
  SELECT user_id, order_date, sum(order_total_revenue) AS daily_revenue,
         count(DISTINCT order_id) AS daily_order_count
  FROM orders3 GROUP BY user_id, order_date
),
running AS (
  SELECT *, round(sum(daily_revenue) OVER w, 2) AS customer_ltv_to_date,
         sum(daily_order_count) OVER w AS lifetime_order_count_to_date
  FROM daily
  WINDOW w AS (PARTITION BY user_id ORDER BY order_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
clv AS (
  SELECT user_id, total_ltv, b AS clv_rank_bucket,
         CASE WHEN b = 1 THEN 'high_clv' WHEN b = 5 THEN 'low_clv' ELSE 'medium_clv' END AS clv_group
  FROM (SELECT user_id, total_ltv, ntile(5) OVER (ORDER BY total_ltv DESC, user_id ASC) AS b
        FROM (SELECT user_id, sum(daily_revenue) AS total_ltv FROM daily GROUP BY user_id))
),
ltv_mart AS (
  SELECT r.user_id, r.order_date, CAST(r.daily_revenue AS DOUBLE) AS daily_revenue,
         CAST(r.daily_order_count AS BIGINT) AS daily_order_count,
         CAST(r.customer_ltv_to_date AS DOUBLE) AS customer_ltv_to_date,
         CAST(r.lifetime_order_count_to_date AS BIGINT) AS lifetime_order_count_to_date,
         c.clv_group
  FROM running r LEFT JOIN clv c ON r.user_id = c.user_id
),
rfm AS (
  SELECT user_id, max(order_date) AS last_order_date, min(order_date) AS first_order_date,
         count(DISTINCT order_id) AS frequency_orders,
         round(sum(order_total_revenue), 2) AS monetary_total_spend,
         CAST(datediff('day', max(order_date), {AS_OF}) AS INTEGER) AS recency_days
  FROM orders3 GROUP BY user_id
),
order_dates AS (SELECT DISTINCT user_id, order_id, order_date FROM orders3),
gaps AS (
  SELECT user_id, order_id, order_date,
         lag(order_date) OVER (PARTITION BY user_id ORDER BY order_date, order_id) AS previous_order_date
  FROM order_dates
),
avg_gap AS (
  SELECT user_id, {_half_up_mean("sum(CAST(datediff('day', previous_order_date, order_date) AS HUGEINT))", "count(previous_order_date)", 0)} AS average_gap_between_orders_days
  FROM gaps GROUP BY user_id
),
periods AS (
  SELECT user_id, order_total_revenue,
         CASE WHEN datediff('day', order_date, {AS_OF}) <= 30 THEN 'last'
              WHEN datediff('day', order_date, {AS_OF}) <= 60 THEN 'previous' END AS period
  FROM orders3
),
period_spend AS (
  SELECT user_id, period, sum(order_total_revenue) AS spend FROM periods
  WHERE period IS NOT NULL GROUP BY user_id, period
),
spend AS (
  SELECT coalesce(l.user_id, p.user_id) AS user_id,
         coalesce(l.spend, 0) AS last_30_day_spend,
         coalesce(p.spend, 0) AS previous_30_day_spend
  FROM (SELECT user_id, spend FROM period_spend WHERE period = 'last') l
  FULL OUTER JOIN (SELECT user_id, spend FROM period_spend WHERE period = 'previous') p
  ON l.user_id = p.user_id
),
spend_pct AS (
  SELECT user_id, last_30_day_spend, previous_30_day_spend,
         CASE WHEN previous_30_day_spend = 0 THEN NULL
              ELSE sign(d) * sign(p) * ((20000 * abs(d) + abs(p)) // (2 * abs(p))) / 100.0 END AS spend_change_pct
  FROM (SELECT *, {_cents('last_30_day_spend - previous_30_day_spend')} AS d,
               {_cents('previous_30_day_spend')} AS p FROM spend)
),
segments_mart AS (
  SELECT b.user_id, b.last_order_date, b.first_order_date,
         CAST(b.frequency_orders AS BIGINT) AS frequency_orders,
         CAST(b.monetary_total_spend AS DOUBLE) AS monetary_total_spend,
         b.recency_days,
         CAST(g.average_gap_between_orders_days AS DOUBLE) AS average_gap_between_orders_days,
         CAST(s.last_30_day_spend AS DOUBLE) AS last_30_day_spend,
         CAST(s.previous_30_day_spend AS DOUBLE) AS previous_30_day_spend,
         CAST(s.spend_change_pct AS DOUBLE) AS spend_change_pct,
         CASE WHEN b.recency_days <= 30 AND b.frequency_orders >= 5 AND b.monetary_total_spend >= 500 THEN 'vip'
              WHEN b.recency_days <= 30 AND b.frequency_orders <= 2 THEN 'new_customer'
              WHEN b.recency_days > 45 AND b.frequency_orders <= 3 THEN 'churn_risk'
              ELSE 'standard' END AS rfm_segment,
         CASE WHEN b.recency_days > 90 THEN 'inactive' WHEN b.recency_days > 45 THEN 'at_risk'
              ELSE 'active' END AS inactivity_tag
  FROM rfm b LEFT JOIN avg_gap g ON b.user_id = g.user_id LEFT JOIN spend_pct s ON b.user_id = s.user_id
),
trend_base AS (
  SELECT *, CAST(order_date AS VARCHAR) AS pv_daily,
         CAST(year(order_date) AS VARCHAR) || '-W' || lpad(CAST(weekofyear(order_date) AS VARCHAR), 2, '0') AS pv_weekly,
         CAST(year(order_date) AS VARCHAR) || '-' || lpad(CAST(month(order_date) AS VARCHAR), 2, '0') AS pv_monthly
  FROM s_items WHERE order_id IS NOT NULL AND order_date IS NOT NULL
),
trends_mart AS (
  {" UNION ALL ".join(
      f"SELECT '{p}' AS period_type, pv_{p} AS period_value, restaurant_id, item_category, currency, "
      f"CAST(round(sum(item_gross_amount), 2) AS DOUBLE) AS total_revenue, "
      f"CAST(count(DISTINCT order_id) AS BIGINT) AS order_count, "
      f"CAST(count(DISTINCT user_id) AS BIGINT) AS customer_count "
      f"FROM trend_base GROUP BY pv_{p}, restaurant_id, item_category, currency"
      for p in ("daily", "weekly", "monthly"))}
),
metric_rows AS (
  SELECT 'loyalty_program_impact' AS metric_type, loyalty_status AS metric_dimension, * FROM orders7
  UNION ALL
  SELECT 'location_performance', restaurant_id, * FROM orders7
  UNION ALL
  SELECT 'discount_effectiveness', CASE WHEN has_discount THEN 'discounted_orders' ELSE 'non_discounted_orders' END, * FROM orders7
),
metrics_mart AS (
  SELECT metric_type, metric_dimension, currency,
         CAST(round(sum(order_total_revenue), 2) AS DOUBLE) AS total_revenue,
         CAST(count(DISTINCT order_id) AS BIGINT) AS total_orders,
         CAST(count(DISTINCT user_id) AS BIGINT) AS total_customers,
         CAST({_money_mean('order_total_revenue')} AS DOUBLE) AS average_order_value
  FROM metric_rows GROUP BY metric_type, metric_dimension, currency
),
seg_view AS (
  SELECT cs.user_id, cs.recency_days, cs.frequency_orders, cs.monetary_total_spend, cs.rfm_segment,
         cs.inactivity_tag, l.clv_group, l.customer_ltv_to_date
  FROM segments_mart cs
  LEFT JOIN (SELECT user_id, clv_group, max(customer_ltv_to_date) AS customer_ltv_to_date
             FROM ltv_mart GROUP BY user_id, clv_group) l
  ON cs.user_id = l.user_id
)
"""


def _q(body: str) -> str:
    return f"WITH {_BASE}\n{body}"


def _metric_view(metric_type: str, label: str) -> str:
    return (
        f"SELECT metric_dimension AS {label}, currency, total_revenue, total_orders, total_customers, "
        f"average_order_value FROM metrics_mart WHERE metric_type = '{metric_type}'"
    )


def _metric_kpis(metric_type: str, label: str) -> str:
    return _q(
        f"SELECT CAST(coalesce(round(sum(CAST(total_revenue AS DECIMAL(20,2))), 2), 0) AS DOUBLE) AS total_revenue, "
        f"CAST(coalesce(sum(total_orders), 0) AS BIGINT) AS total_orders, "
        f"CAST({_money_mean('average_order_value')} AS DOUBLE) AS average_order_value "
        f"FROM ({_metric_view(metric_type, label)})"
    )


def _metric_group(dim: str, label_expr: str, metric_type: str, extra: str = "", rank: bool = False) -> str:
    body = (
        f"SELECT {dim}, currency, CAST(round(sum(order_total_revenue), 2) AS DOUBLE) AS total_revenue, "
        f"CAST(count(DISTINCT order_id) AS BIGINT) AS total_orders, "
        f"CAST(count(DISTINCT user_id) AS BIGINT) AS total_customers, "
        f"CAST({_money_mean('order_total_revenue')} AS DOUBLE) AS average_order_value{extra}, "
        f"'{metric_type}' AS metric_type, {label_expr} AS metric_dimension "
        f"FROM orders7 GROUP BY {dim}, currency"
    )
    if rank:
        body = (
            f"SELECT *, CAST(dense_rank() OVER (ORDER BY total_revenue DESC NULLS LAST) AS INTEGER) "
            f"AS location_revenue_rank FROM ({body})"
        )
    return _q(body)


def _sales_period(p: str) -> str:
    return _q(f"SELECT * FROM trends_mart WHERE period_type = '{p}'")


_QUALITY_TABLES = [
    ("bronze.order_items", "b_items", ['"ORDER_ID"'], None),
    ("silver.order_items", "s_items", ["order_id", "user_id", "order_date"], "item_gross_amount"),
    ("silver.order_item_options", "s_options", ["order_id"], "option_gross_amount"),
    ("silver.date_dim", "s_dates", ["date_key"], None),
    ("gold.customer_ltv_daily", "ltv_mart", ["user_id", "order_date"], "daily_revenue"),
    ("gold.customer_segments", "segments_mart", ["user_id"], "monetary_total_spend"),
    ("gold.sales_trends", "trends_mart", ["period_value"], "total_revenue"),
    ("gold.loyalty_location_discount", "metrics_mart", ["metric_dimension"], "total_revenue"),
]


def _quality() -> str:
    parts = []
    for name, rel, keys, amount in _QUALITY_TABLES:
        null_key = " OR ".join(f"{k} IS NULL" for k in keys)
        amt = f"CAST(sum(CAST({amount} AS DECIMAL(20,2))) AS DOUBLE)" if amount else "CAST(NULL AS DOUBLE)"
        parts.append(
            f"SELECT '{name}' AS table_name, CAST(count(*) AS BIGINT) AS row_count, "
            f"CAST(count(*) FILTER (WHERE {null_key}) AS BIGINT) AS rows_with_null_keys, {amt} AS amount_total FROM {rel}"
        )
    return _q(" UNION ALL ".join(parts))


def oracle_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["bronze_audit"] = _q("SELECT *, 'dbo.order_items' AS bronze_source_table FROM b_items")
    q["silver_order_items"] = _q(
        "SELECT app_name, restaurant_id, creation_time_utc_raw, order_id, user_id, printed_card_number, is_loyalty, "
        "currency, lineitem_id, item_category, item_name, CAST(item_price AS DOUBLE) AS item_price, item_quantity, "
        "strftime(creation_timestamp_utc, '%Y-%m-%d %H:%M:%S') AS creation_timestamp_utc, order_date, loyalty_status, "
        "CAST(item_gross_amount AS DOUBLE) AS item_gross_amount FROM s_items"
    )
    q["silver_order_item_options"] = _q(
        "SELECT order_id, lineitem_id, option_group_name, option_name, CAST(option_price AS DOUBLE) AS option_price, "
        "option_quantity, CAST(option_gross_amount AS DOUBLE) AS option_gross_amount FROM s_options"
    )
    q["silver_date_dim"] = _q("SELECT * FROM s_dates")
    q["option_revenue"] = _q(
        "SELECT order_id, CAST(option_revenue AS DOUBLE) AS option_revenue, "
        "CAST(discount_amount AS DOUBLE) AS discount_amount FROM opt_rev"
    )
    q["order_revenue"] = _q(
        "SELECT user_id, order_id, order_date, CAST(item_revenue AS DOUBLE) AS item_revenue, "
        "CAST(line_items_count AS BIGINT) AS line_items_count, CAST(option_revenue AS DOUBLE) AS option_revenue, "
        "CAST(order_total_revenue AS DOUBLE) AS order_total_revenue FROM orders3"
    )
    q["order_revenue_seven_key"] = _q(
        "SELECT order_id, restaurant_id, user_id, is_loyalty, loyalty_status, order_date, currency, "
        "CAST(item_revenue AS DOUBLE) AS item_revenue, CAST(option_revenue AS DOUBLE) AS option_revenue, "
        "CAST(discount_amount AS DOUBLE) AS discount_amount, CAST(order_total_revenue AS DOUBLE) AS order_total_revenue, "
        "has_discount FROM orders7"
    )
    q["daily_customer_revenue"] = _q(
        "SELECT user_id, order_date, CAST(daily_revenue AS DOUBLE) AS daily_revenue, "
        "CAST(daily_order_count AS BIGINT) AS daily_order_count FROM daily"
    )
    q["running_ltv"] = _q(
        "SELECT user_id, order_date, CAST(daily_revenue AS DOUBLE) AS daily_revenue, "
        "CAST(daily_order_count AS BIGINT) AS daily_order_count, "
        "CAST(customer_ltv_to_date AS DOUBLE) AS customer_ltv_to_date, "
        "CAST(lifetime_order_count_to_date AS BIGINT) AS lifetime_order_count_to_date FROM running"
    )
    q["clv_groups"] = _q(
        "SELECT user_id, CAST(total_ltv AS DOUBLE) AS total_ltv, CAST(clv_rank_bucket AS INTEGER) AS clv_rank_bucket, "
        "clv_group FROM clv"
    )
    q["customer_ltv_daily"] = _q("SELECT * FROM ltv_mart")
    q["rfm_base"] = _q(
        "SELECT user_id, last_order_date, first_order_date, CAST(frequency_orders AS BIGINT) AS frequency_orders, "
        "CAST(monetary_total_spend AS DOUBLE) AS monetary_total_spend, recency_days FROM rfm"
    )
    q["order_gaps"] = _q(
        "SELECT user_id, order_id, order_date, previous_order_date, "
        "CAST(datediff('day', previous_order_date, order_date) AS INTEGER) AS gap_days FROM gaps"
    )
    q["average_order_gap"] = _q(
        "SELECT user_id, CAST(average_gap_between_orders_days AS DOUBLE) AS average_gap_between_orders_days FROM avg_gap"
    )
    q["spend_windows"] = _q(
        "SELECT user_id, CAST(last_30_day_spend AS DOUBLE) AS last_30_day_spend, "
        "CAST(previous_30_day_spend AS DOUBLE) AS previous_30_day_spend, "
        "CAST(spend_change_pct AS DOUBLE) AS spend_change_pct FROM spend_pct"
    )
    q["customer_segments"] = _q("SELECT * FROM segments_mart")
    for p in ("daily", "weekly", "monthly"):
        q[f"sales_{p}"] = _sales_period(p)
    q["sales_trends"] = _q("SELECT * FROM trends_mart")
    q["loyalty_impact"] = _metric_group("loyalty_status", "loyalty_status", "loyalty_program_impact")
    q["location_performance"] = _metric_group("restaurant_id", "restaurant_id", "location_performance", rank=True)
    q["discount_effectiveness"] = _metric_group(
        "has_discount",
        "CASE WHEN has_discount THEN 'discounted_orders' ELSE 'non_discounted_orders' END",
        "discount_effectiveness",
        extra=", CAST(round(sum(discount_amount), 2) AS DOUBLE) AS total_discount_amount",
    )
    q["loyalty_location_discount"] = _q("SELECT * FROM metrics_mart")
    q["loyalty_repeat"] = _q(
        "SELECT loyalty_status, currency, CAST(count(*) AS BIGINT) AS total_customers, "
        "CAST(count(*) FILTER (WHERE n >= 2) AS BIGINT) AS repeat_customers, "
        "CAST(((20000 * count(*) FILTER (WHERE n >= 2) + count(*)) // (2 * count(*))) / 100.0 AS DOUBLE) AS repeat_customer_pct, "
        f"CAST({_half_up_mean('sum(n)', 'count(n)', 0)} AS DOUBLE) AS orders_per_customer "
        "FROM (SELECT loyalty_status, currency, user_id, count(DISTINCT order_id) AS n FROM orders7 "
        "WHERE user_id IS NOT NULL GROUP BY loyalty_status, currency, user_id) GROUP BY loyalty_status, currency"
    )
    q["seasonality"] = _q(
        "SELECT d.day_of_week, d.day_type, d.is_holiday, t.currency, "
        "CAST(round(sum(t.item_gross_amount), 2) AS DOUBLE) AS total_revenue, "
        "CAST(count(DISTINCT t.order_id) AS BIGINT) AS order_count, "
        "CAST(count(DISTINCT t.user_id) AS BIGINT) AS customer_count, "
        "CAST(count(DISTINCT t.order_date) AS BIGINT) AS selling_days "
        "FROM trend_base t LEFT JOIN s_dates d ON t.order_date = d.date_key "
        "GROUP BY d.day_of_week, d.day_type, d.is_holiday, t.currency"
    )
    # dashboards
    q["dash_segmentation"] = _q("SELECT * FROM seg_view")
    q["dash_segment_counts"] = _q(
        "SELECT rfm_segment, CAST(count(user_id) AS BIGINT) AS customer_count FROM seg_view "
        "WHERE rfm_segment IS NOT NULL GROUP BY rfm_segment"
    )
    q["dash_segmentation_kpis"] = _q(
        f"SELECT CAST(count(*) AS BIGINT) AS total_customers, "
        f"CAST({_money_mean('monetary_total_spend')} AS DOUBLE) AS average_spend, "
        f"CAST({_half_up_mean('sum(CAST(frequency_orders AS HUGEINT))', 'count(frequency_orders)', 0)} AS DOUBLE) "
        f"AS average_frequency FROM seg_view"
    )
    churn_cols = (
        "user_id, recency_days, frequency_orders, monetary_total_spend, average_gap_between_orders_days, "
        "last_30_day_spend, previous_30_day_spend, spend_change_pct, rfm_segment, inactivity_tag"
    )
    q["dash_churn"] = _q(f"SELECT {churn_cols} FROM segments_mart")
    q["dash_at_risk"] = _q(f"SELECT {churn_cols} FROM segments_mart WHERE inactivity_tag IN ('at_risk', 'inactive')")
    q["dash_risk_counts"] = _q(
        "SELECT inactivity_tag, CAST(count(user_id) AS BIGINT) AS customer_count FROM segments_mart "
        "WHERE inactivity_tag IS NOT NULL GROUP BY inactivity_tag"
    )
    q["dash_churn_kpis"] = _q(
        f"SELECT CAST(count(*) AS BIGINT) AS total_customers, "
        f"CAST(count(user_id) FILTER (WHERE inactivity_tag IN ('at_risk', 'inactive')) AS BIGINT) AS at_risk_customers, "
        f"CAST({_half_up_mean('sum(CAST(recency_days AS HUGEINT))', 'count(recency_days)', 0)} AS DOUBLE) "
        f"AS average_recency_days FROM segments_mart"
    )
    q["dash_sales_weekly"] = _q("SELECT * FROM trends_mart WHERE period_type = 'weekly'")
    q["mart_sql_sales_monthly"] = _q("SELECT * FROM trends_mart WHERE period_type = 'monthly'")
    q["dash_revenue_trend"] = _q(
        "SELECT period_value, CAST(sum(CAST(total_revenue AS DECIMAL(20,2))) AS DOUBLE) AS total_revenue "
        "FROM trends_mart WHERE period_type = 'monthly' AND period_value IS NOT NULL GROUP BY period_value"
    )
    q["dash_category_revenue"] = _q(
        "SELECT item_category, CAST(sum(CAST(total_revenue AS DECIMAL(20,2))) AS DOUBLE) AS total_revenue "
        "FROM trends_mart WHERE period_type = 'daily' AND item_category IS NOT NULL GROUP BY item_category"
    )
    q["dash_sales_kpis"] = _q(
        "SELECT CAST(coalesce(round(sum(CAST(total_revenue AS DECIMAL(20,2))), 2), 0) AS DOUBLE) AS total_revenue, "
        "CAST(coalesce(sum(order_count), 0) AS BIGINT) AS total_orders, "
        "CAST(coalesce(sum(customer_count), 0) AS BIGINT) AS total_customers "
        "FROM trends_mart WHERE period_type = 'daily'"
    )
    q["dash_loyalty"] = _q(_metric_view("loyalty_program_impact", "loyalty_status"))
    q["dash_loyalty_kpis"] = _metric_kpis("loyalty_program_impact", "loyalty_status")
    q["dash_location_ranking"] = _q(_metric_view("location_performance", "restaurant_id"))
    q["dash_location_kpis"] = _q(
        "SELECT coalesce((SELECT restaurant_id FROM loc ORDER BY total_revenue DESC NULLS LAST, restaurant_id, currency "
        "LIMIT 1), 'N/A') AS top_location, "
        "(SELECT CAST(max(CAST(total_revenue AS DECIMAL(20,2))) AS DOUBLE) FROM loc) AS highest_revenue, "
        f"(SELECT CAST({_money_mean('average_order_value')} AS DOUBLE) FROM loc) AS average_order_value"
    ).replace("\nSELECT coalesce", f", loc AS ({_metric_view('location_performance', 'restaurant_id')})\nSELECT coalesce", 1)
    q["dash_discount"] = _q(_metric_view("discount_effectiveness", "discount_status"))
    q["dash_discount_kpis"] = _metric_kpis("discount_effectiveness", "discount_status")
    q["quality_layer_checks"] = _quality()
    return q
