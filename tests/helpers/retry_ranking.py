"""Run in its own process: distributed NTILE / LAG with injected task
failures (first attempt of every task in the stage after the range shuffle
fails), on a session that retries tasks. Prints JSON with the comparison."""

import json
import os
import random
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from ledgerline.operators import ranking  # noqa: E402
from ledgerline.session import build_session  # noqa: E402
from tests.helpers.plain_windows import plain_ntile  # noqa: E402


def fail_first_attempt(batches):
    ctx = TaskContext.get()
    if ctx.attemptNumber() == 0:
        raise RuntimeError("injected failure on first attempt")
    yield from batches


def main():
    spark = build_session("local[4,3]", shuffle_partitions=6)
    spark.sparkContext.setLogLevel("OFF")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerline-retry-"))
    rnd = random.Random(9)
    rows = [(f"u{i:05d}", float(rnd.randrange(7))) for i in range(4000)]
    df = spark.createDataFrame(rows, "u string, v double")
    order = [("v", False), ("u", True)]
    want = {r.u: r.b for r in plain_ntile(df, 5, order, "b").collect()}
    got_df = ranking.global_ntile(df, 5, order, "b", num_parts=6)
    flaky = got_df.mapInPandas(fail_first_attempt, got_df.schema)
    got = {r.u: r.b for r in flaky.collect()}

    lag_rows = [("hot" if k % 3 == 0 else f"u{k % 50}", f"o{k:05d}", k % 97) for k in range(3000)]
    ldf = spark.createDataFrame(lag_rows, "user_id string, order_id string, d int")
    lorder = [("d", True), ("order_id", True)]
    lwant = {r.order_id: r.p for r in ldf.withColumn("p", F.lag("d").over(Window.partitionBy("user_id").orderBy("d", "order_id"))).collect()}
    lgot_df = ranking.distributed_lag(ldf, ["user_id"], lorder, "d", "p", num_parts=6)
    lgot = {r.order_id: r.p for r in lgot_df.mapInPandas(fail_first_attempt, lgot_df.schema).collect()}
    print(json.dumps({"ntile_equal": got == want, "rows": len(got), "lag_equal": lgot == lwant, "lag_rows": len(lgot)}))
    spark.stop()


if __name__ == "__main__":
    main()
