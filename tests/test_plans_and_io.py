import os

import pytest
from pyspark.sql import functions as F

from conftest import GOLDEN_AS_OF, ITEM_COLS, OPTION_COLS, golden_item_rows, golden_option_rows, text_df
from ledgerline.plans import pipeline
from ledgerline.plans.registry import Inputs, queries
from ledgerline.sources import catalog, ingest, sink
from ledgerline.streaming.silver_stream import stream_silver

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udf_in_any_registered_query(spark):
    for name, fn in queries().items():
        plan = _plan(fn(spark, SF))
        for bad in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
            assert bad not in plan, (name, bad)


def test_scan_prunes_columns_and_pushes_filters(spark):
    i = Inputs(spark, SF)
    plan = _plan(i.items)
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int,l_quantity:double" in plan
    assert "PushedFilters: [IsNotNull(l_orderkey), IsNotNull(l_partkey)]" in plan


def test_period_filter_prunes_union_branches(spark):
    i = Inputs(spark, SF)
    plan = i.trends_for_views.filter(F.col("period_type") == "weekly")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") <= 3 and "Union" not in plan  # members, members of a period, periods


def test_ltv_joins_and_windows_once(spark):
    """Orders are joined and aggregated before the work table; after it, the
    daily rows meet one shuffle by user and no single-partition window."""
    df = Inputs(spark, SF).ltv_mart
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "lineitem" not in plan and "l_orderkey" not in plan
    daily = [x for x in plan.splitlines() if "FileScan parquet" in x and "daily_order_count" in x]
    assert len(daily) == 1 and "Bucketed: true" in daily[0]
    assert "ntile" not in plan.lower()


def test_jdbc_options():
    src = ingest.JdbcSource(
        url="jdbc:sqlserver://db:1433;databaseName=sales",
        table="dbo.order_items",
        user="reader",
        partition_column="ORDER_ID",
        lower_bound=1,
        upper_bound=1_000_000,
        num_partitions=64,
    )
    o = src.options()
    assert o["dbtable"] == "dbo.order_items" and len(src.clauses()) == 64
    assert src.clauses()[0] == "ORDER_ID < 15625 OR ORDER_ID IS NULL" and src.clauses()[-1] == "ORDER_ID >= 984375"
    with pytest.raises(ValueError):
        ingest.JdbcSource(url="u", table="t", partition_column="x").options()


def test_audit_columns(golden):
    out = ingest.add_audit(golden["bronze_items"], "dbo.order_items")
    assert {"bronze_ingestion_timestamp", "bronze_source_table"} <= set(out.columns)
    assert out.select("bronze_source_table").distinct().first()[0] == "dbo.order_items"


def test_versioned_write_and_catalog(spark, scratch, golden):
    p1 = sink.write_layer(golden["items"], scratch, "order_items", version="a")
    p2 = sink.write_layer(golden["items"].limit(3), scratch, "order_items", version="b")
    catalog.register(spark, "ll_test", "items", p1)
    assert spark.table("ll_test.items").count() == 16
    catalog.register(spark, "ll_test", "items", p2)  # re-point = atomic overwrite
    assert spark.table("ll_test.items").count() == 3
    got = catalog.mart_query(spark, "SELECT count(*) AS n FROM ll_test.items WHERE order_id = :o", {"o": "O1"}).first().n
    assert got <= 3


def test_pipeline_end_to_end_and_rerun(spark, scratch):
    sources = {
        "order_items": lambda: text_df(spark, ITEM_COLS, golden_item_rows()),
        "order_item_options": lambda: text_df(spark, OPTION_COLS, golden_option_rows()),
        "date_dim": lambda: spark.createDataFrame(
            [("2024-06-20", "2024", "6", "25", "Thursday", "false", "false", None)],
            "date_key string, year string, month string, week string, day_of_week string, is_weekend string, is_holiday string, holiday_name string",
        ),
    }
    r1 = pipeline.run(spark, sources, scratch, database="ll_pipe", as_of=GOLDEN_AS_OF)
    checks = {r.table_name: r for r in r1.checks.collect()}
    recon = {r.check: r for r in r1.reconciliation.collect()}
    assert len(recon) == 3 and all(r.consistent for r in recon.values()), recon
    assert checks["silver.order_items"].row_count == 16
    assert checks["bronze.order_items"].row_count == 18
    seg = spark.table("ll_pipe.customer_segments")
    assert seg.count() == 5
    weekly = spark.sql("SELECT * FROM ll_pipe.sales_trends WHERE period_type = 'weekly'")
    assert "PartitionFilters: [isnotnull(period_type" in weekly._jdf.queryExecution().executedPlan().toString()
    _views_over_stored_equal_live(spark)
    # each stored trends file is ordered by period_value within its partition folder
    for path in spark.read.parquet(r1.paths["gold.sales_trends"]).inputFiles():
        values = [r.period_value for r in spark.read.parquet(path).select("period_value").collect()]
        assert values == sorted(values)
    first = sorted(tuple(r) for r in spark.table("ll_pipe.customer_segments").drop("gold_processed_timestamp").collect())
    r2 = pipeline.run(spark, sources, scratch, database="ll_pipe", as_of=GOLDEN_AS_OF, retain_versions=1)
    assert r2.version != r1.version
    # retention kept only the published version of every layer table
    for key, path in r2.paths.items():
        layer, name = key.split(".", 1)
        assert sink.list_versions(spark, f"{scratch}/{layer}", name) == [path]
    again = sorted(tuple(r) for r in spark.table("ll_pipe.customer_segments").drop("gold_processed_timestamp").collect())
    assert again == first  # rerun gives the same result


def test_streaming_silver_matches_batch(spark, scratch, golden):
    from ledgerline.operators import silver

    bronze_dir = os.path.join(scratch, "bronze")
    out_dir = os.path.join(scratch, "silver")
    ckpt = os.path.join(scratch, "ckpt")
    rows = golden_item_rows()
    text_df(spark, ITEM_COLS, rows[:9]).write.parquet(os.path.join(bronze_dir, "b1"))
    schema = text_df(spark, ITEM_COLS, rows).schema
    q = stream_silver(spark, "order_items", bronze_dir + "/*", out_dir, schema, checkpoint=ckpt)
    q.awaitTermination()
    text_df(spark, ITEM_COLS, rows[9:]).write.parquet(os.path.join(bronze_dir, "b2"))
    q = stream_silver(spark, "order_items", bronze_dir + "/*", out_dir, schema, checkpoint=ckpt)
    q.awaitTermination()
    got = spark.read.parquet(out_dir).drop("silver_processed_timestamp")
    want = silver.order_items(text_df(spark, ITEM_COLS, rows))
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_jdbc_clauses_match_each_row_once(spark):
    """The clauses as filters over a table with NULL, negative, blank and far keys."""
    rows = [(None,), ("",), ("  ",), ("-7",), ("-0",), ("0",), ("999999999999",), ("-999999999999",), ("x y",), ("ключ",)]
    rows += [(str(k),) for k in range(-50, 300)]
    keys = spark.createDataFrame(rows, "k string").selectExpr("k", "try_cast(k AS bigint) AS n")
    splits = [ingest.range_predicates("n", lo, hi, parts) for lo, hi, parts in ((1, 250, 7), (-20, 20, 64), (0, 0, 4), (5, 9, 1), (-3, 400, 2))]
    splits += [ingest.hash_predicates("hash(k)", 5), ingest.hash_predicates("n", 3), ingest.hash_predicates("length(k)", 1)]
    for clauses in splits:
        assert tuple(ingest.cover(keys, clauses).first()) == (len(rows), 0, 0), clauses
        read = [keys.where(c) for c in clauses]  # as the tasks of a read
        total = sorted((r["k"] for part in read for r in part.collect()), key=str)
        assert total == sorted((k for (k,) in rows), key=str)
    gap = ("n < 5", "n >= 5 AND n < 100", "n >= 99")
    assert tuple(ingest.cover(keys, gap).first()) == (len(rows), 5, 1)  # NULL numbers, and 99 twice


def test_jdbc_predicates_exclude_bounds():
    preds = ingest.hash_predicates("CHECKSUM(ORDER_ID)", 4)
    src = ingest.JdbcSource(url="jdbc:x", table="dbo.t", predicates=preds)
    assert src.clauses() == preds and len(preds) == 5
    with pytest.raises(ValueError):
        ingest.JdbcSource(url="u", table="t", partition_column="x", lower_bound=1, upper_bound=2, num_partitions=2, predicates=preds).options()


def test_delta_gate(spark, golden, scratch):
    if sink.delta_available(spark):
        pytest.skip("Delta present")
    with pytest.raises(RuntimeError):
        sink.write_mart(golden["items"], scratch, "x", fmt="delta")


def test_cli_query(spark, scratch, capsys):
    from ledgerline.__main__ import main

    out = os.path.join(scratch, "q")
    assert main(["query", "loyalty_repeat", "--sf-dir", SF, "--out", out]) == 0
    assert spark.read.parquet(out).count() == 10


def test_adapter_has_one_join_order(spark):
    """The adapter's plan does not depend on sizes, and its rows not on which
    sides Spark broadcasts."""
    from ledgerline.sources import testdata

    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    small = sorted(map(tuple, testdata.bronze_order_items(spark, SF).collect()), key=str)
    try:
        spark.conf.set(key, "-1")
        large = testdata.bronze_order_items(spark, SF)
        assert _plan(large).count("SortMergeJoin") == 5
        assert sorted(map(tuple, large.collect()), key=str) == small
    finally:
        spark.conf.set(key, before)


def test_lines_meet_parts_before_orders(spark):
    """Lines move by part key without the orders' columns, and leave the joins dealt and sorted by order."""
    from ledgerline.sources import testdata

    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "-1")
        plan = _plan(testdata.bronze_order_items(spark, SF))
    finally:
        spark.conf.set(key, before)
    joins = [line for line in plan.splitlines() if "SortMergeJoin" in line]
    assert "l_orderkey" in joins[0] and "l_partkey" in joins[1]


def test_published_versions_replace_partitions_and_columns(spark, scratch):
    """Fewer partitions, more partitions, a new column and an empty version:
    the published name shows the last version alone, also after pruning."""
    versions = [
        ([("daily", 1), ("weekly", 2), ("monthly", 3)], "p string, x int"),
        ([("daily", 4)], "p string, x int"),
        ([("daily", 5), ("yearly", 6)], "p string, x int"),
        ([("daily", 7, "new")], "p string, x int, y string"),
        ([], "p string, x int, y string"),
    ]
    for n, (rows, schema) in enumerate(versions):
        df = spark.createDataFrame(rows, schema)
        path = sink.write_mart(df, f"{scratch}/gold", "t", partition_by=["p"], version=f"{n}")
        catalog.register(spark, "ll_pub", "t", path, schema=df.schema)
        sink.prune_versions(spark, f"{scratch}/gold", "t", 1, {path})
        got = spark.table("ll_pub.t")
        assert sorted(got.columns) == sorted(df.columns)
        assert sorted(map(tuple, got.select(*df.columns).collect())) == sorted(rows)


def test_failed_checks_stop_the_publish(spark, scratch, monkeypatch):
    from ledgerline.plans import quality

    sources = {
        "order_items": lambda: text_df(spark, ITEM_COLS, golden_item_rows()),
        "order_item_options": lambda: text_df(spark, OPTION_COLS, golden_option_rows()),
        "date_dim": lambda: spark.createDataFrame(
            [("2024-06-20", "2024", "6", "25", "Thursday", "false", "false", None)],
            "date_key string, year string, month string, week string, day_of_week string, is_weekend string, is_holiday string, holiday_name string",
        ),
    }
    real = quality.reconciliation_of
    monkeypatch.setattr(pipeline.quality, "reconciliation_of", lambda *a: real(*a).withColumn("consistent", F.lit(False)))
    with pytest.raises(RuntimeError, match="not published"):
        pipeline.run(spark, sources, scratch, database="ll_unpublished", as_of=GOLDEN_AS_OF)
    assert not spark.catalog.tableExists("ll_unpublished.sales_trends")


def test_stream_restart_takes_each_file_once(spark, scratch):
    from ledgerline.schemas import bronze_schema

    rows = lambda n: [(f"O{n}", f"O{n}-1", "x", "y", "1.50", "2")]
    bronze, out = os.path.join(scratch, "bronze"), os.path.join(scratch, "silver")
    for n in range(3):
        src = ingest.add_audit(spark.createDataFrame(rows(n), bronze_schema("order_item_options")), "t")
        src.write.parquet(os.path.join(bronze, f"b{n}"))
        session = spark.newSession()
        stream_silver(session, "order_item_options", bronze + "/*", out, checkpoint=os.path.join(scratch, "c")).awaitTermination()
    assert sorted(r["order_id"] for r in spark.read.parquet(out).collect()) == ["O0", "O1", "O2"]


def test_jdbc_whole_table_reads_are_explicit():
    with pytest.raises(ValueError, match="single_task"):
        ingest.JdbcSource(url="u", table="t").options()
    assert ingest.JdbcSource(url="u", table="t", single_task=True).options()["dbtable"] == "t"


def _views_over_stored_equal_live(spark):
    """Dashboard views over the stored, catalog-registered marts equal the
    same views over the live plans."""
    from ledgerline.operators import silver
    from ledgerline.plans import dashboard as V
    from ledgerline.plans import marts

    stored = {k: v.drop("gold_processed_timestamp") for k, v in V.marts_from_catalog(spark, "ll_pipe").items()}
    items = silver.order_items(text_df(spark, ITEM_COLS, golden_item_rows()))
    options = silver.order_item_options(text_df(spark, OPTION_COLS, golden_option_rows()))
    live = {
        "customer_ltv_daily": marts.customer_ltv_daily(items, options),
        "customer_segments": marts.customer_segments(items, options, GOLDEN_AS_OF),
        "sales_trends": marts.sales_trends(items),
        "loyalty_location_discount": marts.loyalty_location_discount(items, options),
    }

    def views(m):
        return [
            V.segmentation(m["customer_segments"], m["customer_ltv_daily"]),
            V.segmentation_kpis(V.segmentation(m["customer_segments"], m["customer_ltv_daily"])),
            V.churn_kpis(V.churn(m["customer_segments"])),
            V.sales(m["sales_trends"], "weekly"),
            V.sales_kpis(V.sales(m["sales_trends"], "monthly")),
            V.loyalty_kpis(V.loyalty(m["loyalty_location_discount"])),
            V.location_kpis(V.location(m["loyalty_location_discount"])),
            V.discount(m["loyalty_location_discount"]),
        ]

    for a, b in zip(views(stored), views(live)):
        assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


@pytest.mark.parametrize("table", ["order_item_options", "date_dim"])
def test_streaming_silver_other_tables(spark, scratch, table):
    from ledgerline.operators import silver
    from ledgerline.schemas import bronze_schema

    rows = {
        "order_item_options": [("O1", "O1-1", " Extras ", None, "1.50", "2"), ("O2", "O2-1", "x", "y", "bad", "1")],
        "date_dim": [("2024-06-01", "2024", "6", "22", " Saturday", None, "false", None), ("bad-key", "2024", "6", "22", "x", "true", "false", None)],
    }[table]
    bronze_dir = os.path.join(scratch, "bronze")
    src = spark.createDataFrame(rows, bronze_schema(table))
    from ledgerline.sources import ingest as _ingest

    _ingest.add_audit(src, table).write.parquet(os.path.join(bronze_dir, "b1"))
    out = os.path.join(scratch, "silver")
    stream_silver(spark, table, bronze_dir + "/*", out, checkpoint=os.path.join(scratch, "ckpt")).awaitTermination()
    clean = {"order_item_options": silver.order_item_options, "date_dim": silver.date_dim}[table]
    want = clean(src)
    got = spark.read.parquet(out).select(*want.columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert got.count() == 1


def test_cli_pipeline(spark, scratch, capsys):
    from ledgerline.__main__ import main

    root = os.path.join(scratch, "lake")
    args = ["pipeline", "--sf-dir", SF, "--root", root, "--database", "ll_cli", "--as-of", "2001-08-01"]
    assert main(args + ["--retain-versions", "1"]) == 0
    assert main(args + ["--retain-versions", "1"]) == 0
    assert spark.table("ll_cli.customer_segments").count() == 150
    assert spark.table("ll_cli.loyalty_location_discount").count() == 45
    for layer, name in (("silver", "order_items"), ("gold", "sales_trends")):
        assert len(sink.list_versions(spark, f"{root}/{layer}", name)) == 1
    assert os.listdir(os.path.join(root, "work")) == []


def test_single_partition_exchanges_only_carry_partition_counts(spark):
    """In the final (adaptive) plan of every registered query, the only data
    routed through a single partition is the per-range-partition count table
    of the distributed ranking (at most spark.sql.shuffle.partitions rows) or
    a global aggregate's one partial row per task."""
    for name, fn in queries().items():
        df = fn(spark, SF)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        lines = plan.splitlines()
        for k, line in enumerate(lines):
            if "Exchange SinglePartition" not in line:
                continue
            below = " ".join(lines[k + 1 : k + 4])
            assert ("key=[_part" in below) or ("keys=[_part" in below) or ("HashAggregate(keys=[]" in below) or ("partial_" in below), (name, below[:300])


def test_pipeline_stops_at_failed_layer(spark, scratch):
    """A failing bronze job stops the run at the layer barrier: no silver or
    gold version is written and nothing is published."""
    sources = {
        "order_items": lambda: text_df(spark, ITEM_COLS, golden_item_rows()).drop("ITEM_PRICE"),
        "order_item_options": lambda: text_df(spark, OPTION_COLS, golden_option_rows()),
        "date_dim": lambda: spark.createDataFrame(
            [("2024-06-20", "2024", "6", "25", "Thursday", "false", "false", None)],
            "date_key string, year string, month string, week string, day_of_week string, is_weekend string, is_holiday string, holiday_name string",
        ),
    }
    with pytest.raises(ValueError, match="ITEM_PRICE"):
        pipeline.run(spark, sources, scratch, database="ll_fail")
    assert sink.list_versions(spark, f"{scratch}/silver", "order_items") == []
    assert sink.list_versions(spark, f"{scratch}/gold", "sales_trends") == []
    assert not spark.catalog.tableExists("ll_fail.sales_trends")


def _golden_sources(spark):
    return {
        "order_items": lambda: text_df(spark, ITEM_COLS, golden_item_rows()),
        "order_item_options": lambda: text_df(spark, OPTION_COLS, golden_option_rows()),
        "date_dim": lambda: spark.createDataFrame(
            [("2024-06-20", "2024", "6", "25", "Thursday", "false", "false", None)],
            "date_key string, year string, month string, week string, day_of_week string, is_weekend string, is_holiday string, holiday_name string",
        ),
    }


def test_observed_checks_equal_a_second_read(spark, scratch):
    """The run's check rows come from the writing jobs; reading every table again gives the same."""
    from ledgerline.plans import quality

    r = pipeline.run(spark, _golden_sources(spark), scratch, database="ll_obs", as_of=GOLDEN_AS_OF)
    tables = {k: sink.read_layer(spark, p) for k, p in r.paths.items()}
    assert sorted(map(tuple, r.checks.collect())) == sorted(map(tuple, quality.layer_checks(tables).collect()))
    marts = {k.split(".")[1]: df for k, df in tables.items() if k.startswith("gold.")}
    assert sorted(map(tuple, r.reconciliation.collect())) == sorted(map(tuple, quality.reconciliation(marts).collect()))


def test_checks_of_empty_tables(spark, scratch):
    sources = {k: (lambda f=f: f().limit(0)) for k, f in _golden_sources(spark).items()}
    r = pipeline.run(spark, sources, scratch, database="ll_none", as_of=GOLDEN_AS_OF)
    assert {(x.row_count, x.rows_with_null_keys) for x in r.checks.collect()} == {(0, 0)}
    assert catalog.current(spark, f"{scratch}/gold")["sales_trends"].count() == 0


def test_run_that_fails_in_gold_resumes_without_bronze(spark, scratch, monkeypatch):
    from ledgerline.operators import metrics

    sources = _golden_sources(spark)
    real = metrics.loyalty_location_discount

    def broken(*a, **k):
        return real(*a, **k).withColumn("metric_type", F.raise_error(F.lit("no gold today")).cast("string"))

    monkeypatch.setattr(metrics, "loyalty_location_discount", broken)
    with pytest.raises(Exception, match="no gold today"):
        pipeline.run(spark, sources, scratch, database="ll_resume", as_of=GOLDEN_AS_OF)
    assert not spark.catalog.tableExists("ll_resume.customer_segments")
    monkeypatch.undo()
    (version,) = [v for v in os.listdir(f"{scratch}/_runs")]
    before = {n: os.path.getmtime(f"{scratch}/{n}/v={version}") for n in ("silver/order_items", "gold/customer_segments")}
    for name in os.listdir(f"{scratch}/bronze"):
        os.rename(f"{scratch}/bronze/{name}/v={version}", f"{scratch}/bronze/{name}/hidden")  # can't be read
        os.mkdir(f"{scratch}/bronze/{name}/v={version}")
    gone = {k: (lambda: pytest.fail("the source was read again")) for k in sources}
    r = pipeline.run(spark, gone, scratch, database="ll_resume", resume=True)  # and the date is that of the first try
    assert r.version == version
    assert before == {n: os.path.getmtime(f"{scratch}/{n}/v={version}") for n in before}
    fresh = pipeline.run(spark, sources, f"{scratch}/fresh", database="ll_fresh", as_of=GOLDEN_AS_OF)
    for mart in pipeline.GOLD_PARTITIONS:
        a, b = (spark.table(f"{d}.{mart}").drop("gold_processed_timestamp") for d in ("ll_resume", "ll_fresh"))
        assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)
    assert sorted(map(tuple, r.checks.collect())) == sorted(map(tuple, fresh.checks.collect()))
    assert os.listdir(f"{scratch}/work") == []


def test_a_failed_runs_work_is_removed_by_the_next(spark, scratch):
    from ledgerline.sources import work

    with pytest.raises(ZeroDivisionError), work.run_folder(spark, f"{scratch}/work/v=old"):
        work.materialize(spark.range(3), "x")
        raise ZeroDivisionError
    assert len(os.listdir(f"{scratch}/work/v=old")) == 1
    pipeline.run(spark, _golden_sources(spark), scratch, database="ll_work", as_of=GOLDEN_AS_OF)
    assert os.listdir(f"{scratch}/work") == []


def test_readers_never_join_two_versions(spark, scratch):
    """A reader that looks while versions are published always has four marts of one version."""
    import threading

    root, names, stop, seen, wrong = f"{scratch}/gold", list(pipeline.GOLD_PARTITIONS), threading.Event(), set(), []
    for v in range(6):
        for n in names:
            spark.range(1).selectExpr(f"{v} AS v").write.parquet(f"{root}/{n}/v={v}")

    def put(v):
        schema = spark.range(1).selectExpr("1 AS v").schema
        catalog.publish(spark, root, str(v), {n: (f"{root}/{n}/v={v}", "parquet", schema) for n in names})

    def read():
        while not stop.is_set():
            versions = {df.first()["v"] for df in catalog.current(spark, root).values()}
            seen.update(versions)
            if len(versions) != 1:
                wrong.append(versions)

    put(0)
    readers = [threading.Thread(target=read) for _ in range(2)]
    for r in readers:
        r.start()
    held = catalog.current(spark, root)
    for v in range(1, 6):
        put(v)
        threading.Event().wait(0.5)
    stop.set()
    for r in readers:
        r.join()
    assert not wrong and len(seen) > 1
    assert {df.first()["v"] for df in held.values()} == {0}  # taken before the swaps
    catalog.use_current(spark, root)
    assert spark.sql("SELECT DISTINCT v FROM customer_segments JOIN sales_trends USING (v)").collect()[0]["v"] == 5


def test_pipeline_shuffles_the_lines_once(spark, scratch, monkeypatch):
    """Only the work table of store orders reads the lines for both order grains."""
    read = []
    real = sink.read_layer
    monkeypatch.setattr(pipeline.marts, "customer_orders", lambda *a, **k: pytest.fail("lines aggregated again"))
    monkeypatch.setattr(pipeline.sink, "read_layer", lambda s, p, *a: read.append(p) or real(s, p, *a))
    r = pipeline.run(spark, _golden_sources(spark), scratch, database="ll_once", as_of=GOLDEN_AS_OF)
    assert [p for p in read if "/silver/order_items/" in p] == [r.paths["silver.order_items"]]


def test_customer_orders_rolled_up_equal_direct(spark, golden):
    from ledgerline.operators import revenue

    direct = revenue.order_revenue(golden["items"], golden["options"])
    rolled = revenue.customer_orders(revenue.order_revenue(golden["items"], golden["options"], revenue.STORE_GRAIN, with_discount=True))
    assert sorted(map(tuple, direct.select(*rolled.columns).collect()), key=str) == sorted(map(tuple, rolled.collect()), key=str)
