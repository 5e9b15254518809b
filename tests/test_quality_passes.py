"""quality_layer_checks: the lines are joined once for all silver and gold tables."""

from ledgerline.config import TESTDATA_AS_OF
from ledgerline.plans import marts, quality
from ledgerline.plans.registry import Inputs, queries

_ROWS = {
    "region": "r_regionkey long, r_name string", "nation": "n_nationkey long, n_name string, n_regionkey long",
    "customer": "c_custkey long, c_nationkey long, c_mktsegment string",
    "part": "p_partkey long, p_name string, p_type string, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderdate date",
    "lineitem": "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_returnflag string, "
    "l_extendedprice double, l_discount double, l_tax double",
}


def _tables(spark, folder):
    import datetime as dt

    day = dt.date(2024, 1, 1)
    rows = {
        "region": [(0, "AMERICA"), (1, "ASIA")], "nation": [(0, "A", 0), (1, "B", 1), (2, None, 1)],
        "customer": [(c, c % 3, ("BUILDING", "HOUSEHOLD", None)[c % 3]) for c in range(9)] + [(8, 0, "MACHINERY")],
        "part": [(p, f"n{p}", f"t{p % 4}", p + 0.25) for p in range(40)],
        "orders": [(o, o % 9, None if o % 31 == 0 else day + dt.timedelta(days=o * 3 % 366)) for o in range(230)] + [(5, 4, day)],
        "lineitem": [
            (o, (o * 7 + n) % 40, n, None if (o + n) % 23 == 0 else float(o % 5), "ANR"[n % 3], 10.5 * n, 0.09 * (o % 3), 0.02 * (o % 2))
            for o in range(230)
            for n in range(1, 5)
        ],
    }
    for name, schema in _ROWS.items():
        spark.createDataFrame(rows[name], schema).write.parquet(f"{folder}/{name}.parquet")


def test_lines_are_joined_once_for_all_tables(spark, scratch):
    d = f"{scratch}/tables"
    _tables(spark, d)
    got = queries()["quality_layer_checks"](spark, d)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_partkey") and sum("Relation" in x and "l_partkey" in x for x in plan.splitlines()) <= 3  # bronze, options

    i = Inputs(spark, d)
    one_by_one = quality.layer_checks(
        {
            "bronze.order_items": i.bronze_items,
            "silver.order_items": i.items,
            "silver.order_item_options": i.options,
            "silver.date_dim": i.dates,
        },
        {
            "gold.customer_ltv_daily": marts.customer_ltv_daily(i.items, i.options),
            "gold.customer_segments": marts.customer_segments(i.items, i.options, TESTDATA_AS_OF),
            "gold.sales_trends": marts.sales_trends(i.items),
            "gold.loyalty_location_discount": marts.loyalty_location_discount(i.items, i.options),
        },
    )
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, one_by_one.collect()))
