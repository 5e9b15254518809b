"""Work tables: a DataFrame written once to the shared folder and read again.

``run_folder`` gives a run its own folder for them and removes it when the run
has succeeded. Outside a run they lie under the shared folder itself.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from ledgerline.sources import store

_folder: ContextVar[str | None] = ContextVar("ledgerline_work_folder", default=None)


def configured_dir(spark: SparkSession) -> str | None:
    """The shared folder that ``spark.checkpoint.dir`` names, if any."""
    return (
        spark.conf.get("spark.checkpoint.dir", None)
        or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
        or spark.sparkContext.getCheckpointDir()
    )


def work_dir(spark: SparkSession) -> str:
    """The shared folder; a local-mode session without one gets a scratch
    folder of its own (batch work tables need not outlive the application)."""
    folder = configured_dir(spark)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (object store or distributed file system)")
        folder = tempfile.mkdtemp(prefix="ledgerline-work-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


@contextmanager
def run_folder(spark: SparkSession, path: str) -> Iterator[str]:
    """Work tables made inside the block lie in ``path``, which is removed at
    its end. After a failure it stays until the next run of its root."""
    token = _folder.set(path.rstrip("/"))
    try:
        yield path
    finally:
        _folder.reset(token)
    store.delete(spark, path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table: evaluated once however often it is read, and
    the lineage of what follows ends at its files."""
    spark = df.sparkSession
    path = f"{_folder.get() or work_dir(spark)}/work-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def placed(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` as a written table bucketed by ``keys``, one file a bucket, so that
    aggregates, windows and joins on the keys read it without a shuffle. A
    bucket is read by one task: for keys whose rows are bounded. The catalog
    entry that a bucketed write needs is dropped at once; the files stay."""
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"ledgerline_work_{uuid.uuid4().hex}"
    path = f"{_folder.get() or work_dir(spark)}/work-{name}"
    dealt = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
    dealt.option("path", path).format("parquet").saveAsTable(name)
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return out
