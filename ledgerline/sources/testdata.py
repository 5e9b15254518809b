"""Source-shaped (bronze) tables derived from the TPC-H-like testdata.

The engine's sources are three operational tables (order lines, order-line
options, a calendar) delivered as text columns. These adapters derive them from
the testdata tables with deterministic dirt (stray spaces, malformed numbers and
dates, NULL users, blank labels) so every cleaning rule is exercised. All work
is lazy Spark joins and projections; nothing is materialised here.

Join plan, the same at every size: orders x customer (x nation x region), and
lineitem x part; then these two on the order key as a sort-merge join. Lines move
by part key before they carry an order's columns, and come out sorted by order, so
partial sums of an order's lines collapse before the next exchange. The hint on
the last keeps Spark from broadcasting a small line table, which would leave the
lines to the few tasks that read customers; dealt by order key, they are parsed in
parallel however few files they came from. The other joins carry no hint: the
planner broadcasts what is under
``spark.sql.autoBroadcastJoinThreshold``, and AQE checks again at runtime.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def bronze_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines in the source's UPPER_CASE text layout."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag"
    )
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_retailprice")

    # Orders are enriched first, so the lines are joined once on the part key
    # and once on the order key, whatever the sizes.
    customers = c.join(n, c.c_nationkey == n.n_nationkey).join(r, F.col("n_regionkey") == r.r_regionkey)
    enriched_orders = o.join(customers, o.o_custkey == customers.c_custkey).select(
        "o_orderkey", "o_custkey", "o_orderdate", "c_mktsegment", "n_name", "r_name"
    )
    # A line without an order key meets no order: it is dropped in the scan, not carried to its part.
    priced = li.filter(F.col("l_orderkey").isNotNull()).join(p, F.col("l_partkey") == p.p_partkey)
    j = priced.join(enriched_orders.hint("merge"), F.col("l_orderkey") == enriched_orders.o_orderkey)
    ok, ln = F.col("l_orderkey"), F.col("l_linenumber")
    return j.select(
        F.concat(F.lit(" "), F.when(F.col("l_returnflag") == "A", "mobile").otherwise("web"), F.lit(" ")).alias(
            "APP_NAME"
        ),
        F.col("n_name").alias("RESTAURANT_ID"),
        F.when(ok % 211 == 0, F.lit("not-a-date")).otherwise(_s(F.col("o_orderdate"))).alias("CREATION_TIME_UTC"),
        _s(ok).alias("ORDER_ID"),
        F.when(ok % 101 == 0, F.lit(None).cast("string")).otherwise(_s(F.col("o_custkey"))).alias("USER_ID"),
        _s(F.lit(4000000000000000) + F.col("o_custkey")).alias("PRINTED_CARD_NUMBER"),
        F.when(F.col("c_mktsegment").isin("BUILDING", "AUTOMOBILE"), F.lit("true"))
        .when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit(None).cast("string"))
        .otherwise(F.lit("false"))
        .alias("IS_LOYALTY"),
        F.when(F.col("r_name") == "AMERICA", " usd ")
        .when(F.col("r_name") == "EUROPE", " eur ")
        .when(F.col("r_name") == "ASIA", " jpy ")
        .when(F.col("r_name") == "AFRICA", " zar ")
        .otherwise(" aed ")
        .alias("CURRENCY"),
        F.concat(_s(ok), F.lit("-"), _s(ln)).alias("LINEITEM_ID"),
        F.when(F.col("p_partkey") % 17 == 0, F.lit(None).cast("string"))
        .when(F.col("p_partkey") % 19 == 0, F.lit("   "))
        .otherwise(F.concat(F.lit(" "), F.col("p_type"), F.lit(" ")))
        .alias("ITEM_CATEGORY"),
        F.upper(F.col("p_name")).alias("ITEM_NAME"),
        F.when((ok + ln) % 89 == 0, F.lit("n/a"))
        .otherwise(_s(F.col("p_retailprice").cast("decimal(18,2)")))
        .alias("ITEM_PRICE"),
        F.when((ok + ln) % 83 == 0, F.lit(None).cast("string"))
        .otherwise(_s(F.col("l_quantity").cast("int")))
        .alias("ITEM_QUANTITY"),
    )


def bronze_order_item_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Options per order line: surcharges (positive) and discounts (negative)."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_tax", "l_returnflag"
    )
    ok, ln = F.col("l_orderkey"), F.col("l_linenumber")
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    ids = [
        _s(ok).alias("ORDER_ID"),
        F.concat(_s(ok), F.lit("-"), _s(ln)).alias("LINEITEM_ID"),
    ]
    surcharge = li.filter(F.col("l_tax") > 0).select(
        *ids,
        F.when(ln == 7, F.lit("  ")).otherwise(F.lit(" Extras ")).alias("OPTION_GROUP_NAME"),
        F.when(F.col("l_returnflag") == "R", F.lit(None).cast("string"))
        .otherwise(F.lit("Side Dish"))
        .alias("OPTION_NAME"),
        _s(F.round(price * F.col("l_tax").cast("decimal(4,2)"), 2)).alias("OPTION_PRICE"),
        F.lit("1").alias("OPTION_QUANTITY"),
    )
    discount = li.filter(F.col("l_discount") >= 0.09).select(
        *ids,
        F.lit("Discounts").alias("OPTION_GROUP_NAME"),
        F.lit("Promo").alias("OPTION_NAME"),
        F.when(ok % 97 == 0, F.lit("bad"))
        .otherwise(_s(-F.round(price * F.col("l_discount").cast("decimal(4,2)"), 2)))
        .alias("OPTION_PRICE"),
        F.lit("1").alias("OPTION_QUANTITY"),
    )
    return surcharge.unionByName(discount)


# Fixed day-of-week spellings (1 = Sunday .. 7 = Saturday) with deliberate
# stray spaces and mixed case.
_WEEKDAY_TEXT = {
    1: " Sunday",
    2: "MONDAY ",
    3: "Tuesday",
    4: " wednesday ",
    5: "Thursday",
    6: "Friday",
    7: "SATURDAY",
}


def bronze_date_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One calendar row per distinct order date, as source text."""
    d = read_table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("d")).distinct()
    dd = F.col("d")
    wd = F.dayofweek(dd)
    dow = F.lit(None).cast("string")
    for k in sorted(_WEEKDAY_TEXT, reverse=True):
        dow = F.when(wd == k, F.lit(_WEEKDAY_TEXT[k])).otherwise(dow)
    new_year = (F.month(dd) == 1) & (F.dayofmonth(dd) == 1)
    christmas = (F.month(dd) == 12) & (F.dayofmonth(dd) == 25)
    return d.select(
        F.when(F.dayofmonth(dd) == 13, F.lit("bad-key")).otherwise(F.date_format(dd, "yyyy-MM-dd")).alias("date_key"),
        _s(F.year(dd)).alias("year"),
        _s(F.month(dd)).alias("month"),
        _s(F.weekofyear(dd)).alias("week"),
        dow.alias("day_of_week"),
        F.when(F.dayofmonth(dd) == 14, F.lit(None).cast("string"))
        .when(wd.isin(1, 7), F.lit("true"))
        .otherwise(F.lit("false"))
        .alias("is_weekend"),
        F.when(new_year | christmas, F.lit("true")).otherwise(F.lit("false")).alias("is_holiday"),
        F.when(new_year, F.lit(" New Year "))
        .when(christmas, F.lit("Christmas"))
        .otherwise(F.lit(None).cast("string"))
        .alias("holiday_name"),
    )


BRONZE_BUILDERS = {
    "order_items": bronze_order_items,
    "order_item_options": bronze_order_item_options,
    "date_dim": bronze_date_dim,
}
