"""Skew check: one user holds a third of all orders.

Usage: python -m checks.skew_check [n_orders] [scratch_dir]

Builds a synthetic customer-grain order table (Spark-generated, not a
registered query) in which user ``hot`` owns a third of the orders, runs the
operators that group or window by user, and reads Spark's event log (written
to ``scratch_dir``) to report, for every stage that reads a shuffle, the
largest share of the stage's shuffle records that a single task read. A
single-task stage (tiny inputs such as per-range-partition counts) reads 100%
by definition and is listed separately.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile


def _stages(log_dir: str):
    import zstandard

    files = sorted(glob.glob(os.path.join(log_dir, "*", "events_*")) + glob.glob(os.path.join(log_dir, "*.zstd")))
    per_stage: dict[int, list[int]] = {}
    for f in files:
        with open(f, "rb") as fh:
            stream = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
            for line in stream:
                e = json.loads(line)
                if e["Event"] == "SparkListenerTaskEnd":
                    m = e.get("Task Metrics") or {}
                    rec = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                    per_stage.setdefault(e["Stage ID"], []).append(rec)
    return per_stage


def _orders(spark, n_orders: int):
    from pyspark.sql import functions as F

    ids = spark.range(0, n_orders, numPartitions=16)
    return ids.select(
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .otherwise(F.concat(F.lit("u"), (F.col("id") % 100_003).cast("string")))
        .alias("user_id"),
        F.concat(F.lit("o"), F.col("id").cast("string")).alias("order_id"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 1500).cast("int")).alias("order_date"),
        ((F.col("id") % 9973).cast("decimal(18,2)") / 100).cast("decimal(18,2)").alias("order_total_revenue"),
    )


def _lines(spark, n_lines: int):
    """Silver-like order lines in which one (day, restaurant, category,
    currency) group holds a third of all lines."""
    from pyspark.sql import functions as F

    ids = spark.range(0, n_lines, numPartitions=16)
    hot = F.col("id") % 3 == 0
    return ids.select(
        F.when(hot, F.lit("2021-06-01").cast("date"))
        .otherwise(F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 900).cast("int")))
        .alias("order_date"),
        F.when(hot, F.lit("R0")).otherwise(F.concat(F.lit("R"), (F.col("id") % 25).cast("string"))).alias("restaurant_id"),
        F.when(hot, F.lit("pizza")).otherwise(F.concat(F.lit("c"), (F.col("id") % 150).cast("string"))).alias("item_category"),
        F.when(hot, F.lit("USD")).otherwise(F.lit("EUR")).alias("currency"),
        F.concat(F.lit("o"), (F.col("id") / 4).cast("long").cast("string")).alias("order_id"),
        F.concat(F.lit("u"), (F.col("id") % 50_000).cast("string")).alias("user_id"),
        (F.col("id") % 5000).cast("decimal(18,2)").alias("item_gross_amount"),
        F.lit(True).alias("is_loyalty"),
        F.lit("loyalty").alias("loyalty_status"),
    )


def _measure(n_orders: int, log_dir: str, build, rows=None) -> dict:
    from ledgerline.session import build_session

    os.makedirs(log_dir, exist_ok=True)
    spark = build_session(
        "local[8]",
        shuffle_partitions=16,
        extra_conf={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir, "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    for df in build((rows or _orders)(spark, n_orders)):
        df.write.format("noop").mode("overwrite").save()
    spark.stop()
    worst, single = [], []
    for sid, recs in sorted(_stages(log_dir).items()):
        total = sum(recs)
        if total == 0:
            continue
        if len(recs) == 1:
            single.append(total)
            continue
        worst.append((max(recs) / total, sid, len(recs), total))
    worst.sort(reverse=True)
    return {
        "multi_task_shuffle_stages": len(worst),
        "largest_task_share": round(worst[0][0], 3) if worst else None,
        "single_task_stages": len(single),
        "single_task_stage_max_records": max(single) if single else 0,
    }


def main(n_orders: int = 3_000_000, scratch: str | None = None) -> None:
    sys.path.insert(0, ".")
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from ledgerline.operators import customers, revenue

    base = scratch or tempfile.mkdtemp(prefix="ledgerline-skew-")
    ours = _measure(
        n_orders,
        os.path.join(base, "ours"),
        lambda o: [
            customers.customer_segments(o, "2024-01-01"),
            customers.order_gaps(o),
            customers.customer_ltv_daily(revenue.daily_customer_revenue(o)),
        ],
    )
    contrast = _measure(
        n_orders,
        os.path.join(base, "plain_window_lag"),
        lambda o: [
            o.withColumn(
                "previous_order_date",
                F.lag("order_date").over(Window.partitionBy("user_id").orderBy("order_date", "order_id")),
            )
        ],
    )
    from ledgerline.operators import metrics, trends

    def _hot_group(lines):
        store = lines.groupBy(
            "order_id", "restaurant_id", "user_id", "is_loyalty", "loyalty_status", "order_date", "currency"
        ).agg(F.sum("item_gross_amount").alias("order_total_revenue")).withColumn("has_discount", F.lit(False))
        return [trends.sales_trends(lines), metrics.loyalty_location_discount(store)]

    hot_group = _measure(n_orders, os.path.join(base, "hot_group"), _hot_group, rows=_lines)
    print(json.dumps({
        "rows": n_orders,
        "hot_share": round(1 / 3, 3),
        "ours_hot_user": ours,
        "plain_window_lag_hot_user": contrast,
        "ours_hot_group_trends_and_metrics": hot_group,
    }, indent=1))


if __name__ == "__main__":
    args = sys.argv[1:]
    main(int(args[0]) if args else 3_000_000, args[1] if len(args) > 1 else None)
