import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.operators import ranking
from tests.helpers.plain_windows import plain_ntile


def _data(spark, n, distinct_values, seed, with_null=False):
    rnd = random.Random(seed)
    rows = [(f"u{i:05d}", float(rnd.randrange(distinct_values))) for i in range(n)]
    if with_null and n:
        rows[0] = (rows[0][0], None)
    rnd.shuffle(rows)
    return spark.createDataFrame(rows, "u string, v double")


@pytest.mark.parametrize(
    "n,distinct,parts",
    [(0, 1, 4), (1, 1, 4), (3, 2, 4), (4, 10, 3), (5, 1, 4), (17, 3, 5), (1000, 7, 8), (2503, 1, 8), (997, 1000, 16)],
)
@pytest.mark.parametrize("k", [5, 3])
def test_global_ntile_matches_window(spark, n, distinct, parts, k):
    df = _data(spark, n, distinct, seed=n * 31 + k, with_null=n > 10)
    order = [("v", False), ("u", True)]
    want = {r.u: r.b for r in plain_ntile(df, k, order, "b").collect()}
    got = {r.u: r.b for r in ranking.global_ntile(df, k, order, "b", num_parts=parts).collect()}
    assert got == want


def test_global_ntile_fewer_rows_than_buckets(spark):
    df = _data(spark, 4, 10, seed=1)
    got = sorted(r.b for r in ranking.global_ntile(df, 5, [("v", False), ("u", True)], "b").collect())
    assert got == [1, 2, 3, 4]  # nobody lands in bucket 5 (T15)


def test_bucket_sizes_differ_by_at_most_one(spark):
    df = _data(spark, 1234, 13, seed=7)
    counts = [r["count"] for r in ranking.global_ntile(df, 5, [("v", False), ("u", True)], "b").groupBy("b").count().collect()]
    assert sum(counts) == 1234 and max(counts) - min(counts) <= 1


def test_global_index_is_a_permutation(spark):
    df = _data(spark, 3000, 4, seed=3)
    idx = [r._gidx for r in ranking.global_index(df, [("v", True), ("u", True)], num_parts=8).collect()]
    assert sorted(idx) == list(range(3000))


@pytest.mark.parametrize("desc", [True, False])
def test_global_dense_rank(spark, desc):
    df = _data(spark, 300, 20, seed=11, with_null=True)
    key = F.col("v").desc_nulls_last() if desc else F.col("v").asc_nulls_first()
    want = {r.u: r.r for r in df.withColumn("r", F.dense_rank().over(Window.orderBy(key))).collect()}
    got = {r.u: r.r for r in ranking.global_dense_rank(df, "v", desc, "r", num_parts=4).collect()}
    assert got == want


def test_distributed_lag_matches_window(spark):
    rnd = random.Random(5)
    base = dt.date(2024, 1, 1)
    rows = []
    for k in range(600):
        user = "hot" if k % 3 == 0 else f"u{rnd.randrange(40)}"  # one user holds a third of the rows
        rows.append((user, f"o{k:04d}", base + dt.timedelta(days=rnd.randrange(200))))
    df = spark.createDataFrame(rows, "user_id string, order_id string, order_date date")
    order = [("order_date", True), ("order_id", True)]
    w = Window.partitionBy("user_id").orderBy(*ranking.sort_columns(order))
    want = {r.order_id: r.prev for r in df.withColumn("prev", F.lag("order_date").over(w)).collect()}
    got = {
        r.order_id: r.prev
        for r in ranking.distributed_lag(df, ["user_id"], order, "order_date", "prev", num_parts=6).collect()
    }
    assert got == want


def test_rows_are_ranked_in_many_parts(spark):
    df = _data(spark, 1000, 5, seed=2)
    parts = ranking.with_part(df, [("v", False), ("u", True)], 8).groupBy("_part").count().collect()
    assert len(parts) == 8 and max(r["count"] for r in parts) < 300


@pytest.mark.parametrize("reuse,aqe", [("false", "true"), ("false", "false"), ("true", "true")])
def test_positions_with_payload_and_without_exchange_reuse(spark, reuse, aqe):
    """Positions hold if the input is evaluated more than once, with columns that the counts don't need."""
    n = 400_000
    df = spark.range(n).select(
        F.pmod(F.xxhash64("id"), F.lit(1000)).alias("v"),
        F.concat(F.lit("u"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10**12))).alias("u"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    ).dropDuplicates(["u"]).repartition(16)
    old = {k: spark.conf.get(k, "true") for k in ("spark.sql.exchange.reuse", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    spark.conf.set("spark.sql.adaptive.enabled", aqe)
    try:
        order = [("v", False), ("u", True)]
        got = ranking.global_index(df, order, "i", "n", num_parts=16)
        want = df.select("u", (F.row_number().over(Window.orderBy(*ranking.sort_columns(order))) - 1).alias("w"))
        both = got.join(want, "u")
        rows = df.count()
        assert both.where("i = w").count() == rows == both.select("n").first()[0]
        days = df.select(F.expr("concat('c', v % 50)").alias("user_id"), F.col("u").alias("order_id"), F.col("v").alias("d"), "payload")
        lagged = ranking.distributed_lag(days, ["user_id"], [("d", True), ("order_id", True)], "d", "p", num_parts=16)
        w = Window.partitionBy("user_id").orderBy("d", "order_id")
        plain = days.withColumn("q", F.lag("d").over(w)).select("order_id", "q")
        assert lagged.join(plain, "order_id").where("p <=> q").count() == rows == lagged.count()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_sampling_keeps_a_share_in_every_task(spark):
    """At 1,000 partitions no task keeps more than a few rows of a sample of 2,000."""
    n, want = 400_000, 2_000
    keys = spark.range(0, n, 1, 1000).select(F.struct(F.col("id").alias("v")).alias("k"))
    per_task = ranking.sampled(keys, n, want).groupBy(F.spark_partition_id().alias("p")).count().collect()
    total = sum(r["count"] for r in per_task)
    assert 0.8 * want < total < 1.2 * want and max(r["count"] for r in per_task) < 20
    assert ranking.sampled(keys, 10, 10) is keys  # as few rows as wanted: all


def test_parts_follow_the_data(spark, monkeypatch):
    df = spark.range(3000).select(F.concat(F.lit("u'\"\\"), "id").alias("u"), (F.col("id") % 7).cast("decimal(18,2)").alias("v"))
    monkeypatch.setattr(ranking, "ROWS_PER_PART", 30)
    tagged = ranking.with_part(df, [("v", False), ("u", True)])
    counts = [r["count"] for r in tagged.groupBy("_part").count().collect()]
    assert len(counts) == 100 and max(counts) < 120
    plan = tagged._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in plan  # the bounds are one constant
    monkeypatch.setattr(ranking, "MAX_PARTS", 10)
    assert ranking.with_part(df, [("v", False), ("u", True)]).select("_part").distinct().count() == 10
