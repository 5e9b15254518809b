"""Layer pipeline (S11): bronze -> silver -> gold, stop on the first failure.

Layers exchange data only through storage: each layer reads the folders the
previous one wrote, so the lineage of a gold plan never reaches back into the
source database, and a lost executor only re-runs work inside the current
layer. Every table is written to a new versioned folder and entered in the run's
ledger, with its check figures, which the writing job itself observed. A failed
run is resumed from there (``resume``): tables in the ledger are taken over, and
its date stays the one it began with.

All marts are published at once, by one pointer under ``<root>/gold``
(``catalog.current``), and then as views one by one, only after all are written
and their checks have passed. A run that fails a check raises and publishes
nothing.

The root folder must be shared storage visible to every executor (object store
or distributed file system), never a machine-local temporary folder. One run
per root at a time: retention keeps the newest versions and the published ones,
and a run removes the work folders of others.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor, wait
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.config import DEFAULT_THRESHOLDS, Thresholds
from ledgerline.operators import revenue, silver
from ledgerline.plans import marts, quality
from ledgerline.plans.ledger import RunLedger, unfinished
from ledgerline.schemas import GOLD, require_bronze_columns
from ledgerline.sources import catalog, ingest, sink, store, work

BRONZE_SOURCES = {
    "order_items": "dbo.order_items",
    "order_item_options": "dbo.order_item_options",
    "date_dim": "dbo.date_dim",
}

# Gold marts and the column each is partitioned by (dashboard predicates on
# that column become partition filters).
GOLD_PARTITIONS = {
    "customer_ltv_daily": None,
    "customer_segments": None,
    "sales_trends": ["period_type"],
    "loyalty_location_discount": ["metric_type"],
}

# Each mart is written sorted within its write tasks (no shuffle) by the key
# dashboards filter or look up on, so parquet row-group min/max statistics let
# readers skip row groups.
GOLD_SORT = {
    "customer_ltv_daily": ["user_id", "order_date"],
    "customer_segments": ["user_id"],
    "sales_trends": ["period_value"],
    "loyalty_location_discount": ["metric_dimension"],
}


def _run_layer_serial(jobs: dict[str, Callable[[], str]]) -> dict[str, str]:
    return {key: job() for key, job in jobs.items()}


def _run_layer(jobs: dict[str, Callable[[], str]]) -> dict[str, str]:
    """Run one layer's independent writes as concurrent Spark jobs and wait
    for all of them (the layer barrier). If any fails, its error is raised
    after the others finish, so no later layer starts."""
    with ThreadPoolExecutor(max_workers=max(1, len(jobs)), thread_name_prefix="ledgerline-layer") as pool:
        futures = {key: pool.submit(job) for key, job in jobs.items()}
        wait(futures.values())
    out = {}
    for key, fut in futures.items():
        out[key] = fut.result()  # re-raises the first failure in key order
    return out


@dataclass
class RunResult:
    version: str
    paths: dict[str, str] = field(default_factory=dict)
    checks: DataFrame | None = None
    reconciliation: DataFrame | None = None


def run(
    spark: SparkSession,
    sources: dict[str, Callable[[], DataFrame]],
    root: str,
    database: str = "ledgerline_gold",
    as_of: _dt.date | str | None = None,
    thresholds: Thresholds = DEFAULT_THRESHOLDS,
    gold_format: str = "parquet",
    version: str | None = None,
    retain_versions: int | None = None,
    parallel: bool = True,
    resume: bool = False,
) -> RunResult:
    """Run all layers. ``sources`` maps each bronze table name
    (order_items, order_item_options, date_dim) to a zero-argument function
    returning the source DataFrame (e.g. ``ingest.read_source`` over JDBC).
    ``as_of``: the session's date when the run began if None.
    ``retain_versions``: after a successful publish, keep only this many
    versions per layer table (the published ones are never deleted).
    ``parallel``: the writes of one layer run as concurrent Spark jobs (they
    are independent); layers stay barriers and the first failure stops the
    run before the next layer starts.
    ``resume``: go on with ``version``, or with the newest run that has not
    published; a new run if there is none."""
    root = root.rstrip("/")
    open_runs = unfinished(spark, root) if resume else []
    v = version or (open_runs[-1] if open_runs else sink.new_version_id())
    ledger = RunLedger(spark, root, v)
    today = as_of or spark.range(1).select(F.current_date()).first()[0]
    as_of = ledger.settings({"as_of": str(today)})["as_of"]
    for other in store.names(spark, f"{root}/work"):
        if other != f"v={v}":
            store.delete(spark, f"{root}/work/{other}")  # a failed run's
    with work.run_folder(spark, f"{root}/work/v={v}"):
        return _run(spark, sources, root, database, as_of, thresholds, gold_format, retain_versions, parallel, ledger)


def _run(
    spark: SparkSession,
    sources: dict[str, Callable[[], DataFrame]],
    root: str,
    database: str,
    as_of: str,
    thresholds: Thresholds,
    gold_format: str,
    retain_versions: int | None,
    parallel: bool,
    ledger: RunLedger,
) -> RunResult:
    v = ledger.version
    res = RunResult(version=v)
    metrics: dict[str, dict] = {}
    layer = _run_layer if parallel else _run_layer_serial

    def written(key: str, build: Callable[[], DataFrame], write: Callable[[DataFrame], str], folder: str) -> dict:
        """The table's ledger entry; the table is built and written only if it has none."""
        found = ledger.committed(key)
        if found is None:
            if gold_format != "delta" or not key.startswith("gold."):
                store.delete(spark, folder)  # what a failed job may have left
            df, taken = quality.observed(build(), key.split(".", 1)[1])
            path = write(df)
            found = ledger.commit(key, path, taken())
        return found

    def run_layer(jobs: dict[str, Callable[[], dict]]) -> None:
        for key, found in layer(jobs).items():
            res.paths[key] = found["path"]
            metrics[key] = found["metrics"]

    def to_layer(name: str, table: str, build: Callable[[], DataFrame]) -> Callable[[], dict]:
        folder = f"{root}/{name}/{table}/v={v}"
        write = lambda df: sink.write_layer(df, f"{root}/{name}", table, version=v)
        return lambda: written(f"{name}.{table}", build, write, folder)

    # bronze: source -> parquet + audit columns
    def bronze(name: str, table: str) -> Callable[[], DataFrame]:
        def build() -> DataFrame:
            src = sources[name]()
            require_bronze_columns(src, name)
            return ingest.add_audit(src, table)

        return build

    run_layer({f"bronze.{n}": to_layer("bronze", n, bronze(n, t)) for n, t in BRONZE_SOURCES.items()})

    # silver: bronze folders -> cleaned parquet
    cleaners = {
        "order_items": silver.order_items,
        "order_item_options": silver.order_item_options,
        "date_dim": silver.date_dim,
    }

    def cleaned(name: str, clean: Callable[..., DataFrame]) -> Callable[[], DataFrame]:
        return lambda: clean(sink.read_layer(spark, res.paths[f"bronze.{name}"]), audit=True)

    run_layer({f"silver.{n}": to_layer("silver", n, cleaned(n, c)) for n, c in cleaners.items()})

    # gold: silver folders -> marts. The lines are aggregated to orders once, at
    # the store grain, and written to the run's work folder; the customer grain
    # is rolled up from there and shared by both customer marts.
    read = lambda key: sink.read_layer(spark, res.paths[key])

    def to_work(table: str, build: Callable[[], DataFrame]) -> None:
        folder = f"{root}/work/v={v}/{table}"

        def write(df: DataFrame) -> str:
            df.write.parquet(folder)
            return folder

        run_layer({f"work.{table}": lambda: written(f"work.{table}", build, write, folder)})

    marts_left = [n for n in GOLD_PARTITIONS if ledger.committed(f"gold.{n}") is None]
    gold: dict[str, DataFrame] = {}
    if marts_left:
        items, options = read("silver.order_items"), read("silver.order_item_options")
        to_work("store_orders", lambda: marts.store_orders(items, options))
        to_work("customer_orders", lambda: revenue.customer_orders(read("work.store_orders")))
        orders = read("work.customer_orders")
        builders = {
            "customer_ltv_daily": lambda: marts.customer_ltv_daily(items, options, thresholds, audit=True, orders=orders),
            "customer_segments": lambda: marts.customer_segments(items, options, as_of, thresholds, audit=True, orders=orders),
            "sales_trends": lambda: marts.sales_trends(items, audit=True),
            "loyalty_location_discount": lambda: marts.loyalty_location_discount(
                items, options, audit=True, orders=read("work.store_orders")
            ),
        }
        gold = {n: builders[n]() for n in marts_left}

    def to_gold(name: str) -> Callable[[], dict]:
        def write(df: DataFrame) -> str:
            # partition columns first: the writer needs that order, and the key
            # order within each partition folder survives
            ordered = df.sortWithinPartitions(*(GOLD_PARTITIONS[name] or []), *GOLD_SORT[name])
            return sink.write_mart(ordered, f"{root}/gold", name, gold_format, GOLD_PARTITIONS[name], version=v)

        return lambda: written(f"gold.{name}", lambda: gold[name], write, f"{root}/gold/{name}/v={v}")

    run_layer({f"gold.{n}": to_gold(n) for n in GOLD_PARTITIONS})
    for key in [k for k in res.paths if k.startswith("work.")]:
        del res.paths[key], metrics[key]  # they go with the run's work folder

    # checks over what was observed, before anything is published
    res.checks = quality.checks_of(spark, metrics)
    marts_metrics = {n: metrics[f"gold.{n}"] for n in GOLD_PARTITIONS}
    res.reconciliation = quality.reconciliation_of(spark, marts_metrics)
    failed = [f"{r['check']}: {r['detail']}" for r in res.reconciliation.collect() if not r["consistent"]]
    if failed:
        raise RuntimeError(f"run {v} is not published; checks failed: {'; '.join(failed)}")

    # publish: all marts at once by the pointer, then the names of the catalog
    schemas = {n: GOLD[n] for n in GOLD_PARTITIONS}
    catalog.publish(
        spark, f"{root}/gold", v, {n: (res.paths[f"gold.{n}"], gold_format, schemas[n]) for n in GOLD_PARTITIONS}
    )
    for name, schema in schemas.items():
        catalog.register(spark, database, name, res.paths[f"gold.{name}"], gold_format, schema)
    ledger.publish()

    # retention: bounded storage for the versioned layers
    if retain_versions:
        published = set(res.paths.values())
        for key in res.paths:
            layer_name, name = key.split(".", 1)
            if gold_format == "delta" and layer_name == "gold":
                continue
            sink.prune_versions(spark, f"{root}/{layer_name}", name, retain_versions, published)
    return res
