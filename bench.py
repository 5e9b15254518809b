"""Benchmark the headline queries.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3), BENCH_LITERAL (default 1: also time the alternative
plan shapes of the marts for comparison).

Each query is executed in full with the ``noop`` sink (no collect). All
queries are warmed up once, then run in BENCH_RUNS rounds (every query once per
round) and the median per query is reported. Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "silver_order_items",
    "customer_ltv_daily",
    "customer_segments",
    "sales_trends",
    "loyalty_location_discount",
    "dash_segmentation",
    "dash_location_kpis",
    "loyalty_repeat",
    "seasonality",
]


def _literal_queries():
    from ledgerline.plans import marts
    from ledgerline.plans.registry import Inputs

    def trends(spark, sf):
        i = Inputs(spark, sf)
        return marts.sales_trends(i.items, method="union")

    def metrics(spark, sf):
        i = Inputs(spark, sf)
        return marts.loyalty_location_discount(i.items, i.options, method="union")

    return {
        "sales_trends__union": trends,
        "loyalty_location_discount__union": metrics,
    }


def _run(spark, fn, sf_dir):
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def _time_all(spark, fns, sf_dir, runs):
    """Warm every query once, then measure in rounds (each round runs every
    query once), so JIT warm-up and run order do not favour any query."""
    for fn in fns.values():
        _run(spark, fn, sf_dir)
    times = {name: [] for name in fns}
    for _ in range(runs):
        for name, fn in fns.items():
            times[name].append(_run(spark, fn, sf_dir))
    return {name: round(statistics.median(t), 3) for name, t in times.items()}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    literal = os.environ.get("BENCH_LITERAL", "1") == "1"

    from ledgerline.plans.registry import queries
    from ledgerline.session import build_session

    spark = build_session(
        f"local[{cpus}]",
        app_name="ledgerline-bench",
        shuffle_partitions=max(8, cpus * 2),
        extra_conf={"spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    qs = queries()
    fns = {name: qs[name] for name in HEADLINE}
    alternatives = _literal_queries() if literal else {}
    timed = _time_all(spark, {**fns, **alternatives}, sf_dir, runs)
    results = {name: timed[name] for name in HEADLINE}
    lit = {name: timed[name] for name in alternatives}
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    out = {
        "metric": "headline_queries_total",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "runs": runs,
        "alternative_plans": lit,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
