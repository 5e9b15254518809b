"""Helpers that the training-data operators share."""

from __future__ import annotations

import gc
import tempfile
import uuid
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names. Only a local session (tests)
    without the setting gets a folder of its own."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    configured = tempfile.mkdtemp(prefix="llm-shared-")
    spark.conf.set("spark.checkpoint.dir", configured)
    return configured


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again: the lineage ends
    there, so a lost executor costs no more than the stages since."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    schema = df.schema
    del df
    release(spark)
    return spark.read.schema(schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Lets Spark's cleaner drop the shuffle files of jobs whose results are written: it
    learns of them when Python's and then the JVM's garbage collection find them unused.
    The last job's are held until another one has run."""
    spark.range(1).count()
    gc.collect()
    spark.sparkContext._jvm.System.gc()


_kept: dict[str, tuple] = {}


def kept(kind: str, key, make):
    """What ``make`` gives, kept in this Python worker across tasks: caches and tables of one operator. There is
    one place for all: when another ``kind`` or ``key`` is asked for, what was kept before goes, so caches of
    operators that ran earlier in the application don't pile up."""
    if _kept.get("own", (None, None, None))[:2] != (kind, key):
        _kept.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        _kept["own"] = kind, key, make()
    return _kept["own"][2]


def row_key() -> Column:
    """64-bit identity of a document row. Repeated rows share it, and as they have one
    text, whatever is computed for the key holds for each of them."""
    return F.xxhash64("doc_id", "text")


def least_hashes(df: DataFrame, rows: int, order: Column, want: int, usable: Column | None = None) -> DataFrame:
    """The ``want`` of about ``rows`` rows that are ``usable`` (all by default) with the least 64-bit hash ``order``
    (or all, if they are few). Rows over a threshold that the count sets are dropped first, so each task keeps its
    share of the sample and not ``want`` rows, and only few rows need ``usable`` worked out."""
    ordered = df
    share = 1.1 * want + 10 * want**0.5
    if rows > share:
        ordered = df.where(order < F.lit(-(1 << 63) + int((1 << 64) * (share / rows))))
    if usable is not None:
        ordered = ordered.where(usable)
    return ordered.orderBy(order).limit(want)


def repeated(df: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose ``keys`` occur at least twice. Counts are combined before the
    shuffle, and the semi-join is one that AQE can split at a hot key."""
    twice = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*keys)
    return df.join(twice, keys, "left_semi")


#: Rows of an Arrow batch at most. Texts of some kB make batches of a few MB, on both sides of a Python worker.
BATCH_ROWS = 2_000


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, whose Python need not have it on its path (once per application), and
    bounds the rows of the session's Arrow batches."""
    sc = spark.sparkContext
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))
    if getattr(sc, "_llm_shipped", False):
        return
    top = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="llm-code-")) / f"{top.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in top.rglob("*.py"):
            z.write(f, f.relative_to(top.parent))
    sc.addPyFile(str(archive))
    sc._llm_shipped = True
