"""Layer storage: parquet for bronze/silver, parquet or Delta for gold marts.

Overwrites are made safe for reruns and for readers of the previous result:
each write goes to a new versioned folder ``<root>/<table>/v=<id>`` and the
published view is replaced afterwards (``catalog.register``). A failed or
retried job never leaves a half-overwritten table behind, and Spark never
overwrites a folder the same job is reading. With Delta available
(``fmt="delta"``) the format's own atomic overwrite is used instead.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession


def _join(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), *[p.strip("/") for p in parts]])


def new_version_id() -> str:
    return f"{time.strftime('%Y%m%dT%H%M%S', time.gmtime())}-{uuid.uuid4().hex[:8]}"


def write_layer(
    df: DataFrame,
    root: str,
    table: str,
    partition_by: list[str] | None = None,
    version: str | None = None,
    fmt: str = "parquet",
) -> str:
    """Write ``df`` to a fresh versioned folder and return its path."""
    path = _join(root, table, f"v={version or new_version_id()}")
    w = df.write.mode("errorifexists").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def read_layer(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read a layer folder (schema from the files)."""
    return spark.read.format(fmt).load(path)


def delta_available(spark: SparkSession) -> bool:
    """True when the Delta Lake classes are on the session's classpath."""
    try:
        spark.sparkContext._jvm.java.lang.Class.forName("io.delta.tables.DeltaTable")
        return True
    except Exception:
        return False


def require_delta(spark: SparkSession) -> None:
    if not delta_available(spark):
        raise RuntimeError(
            "fmt='delta' needs the Delta Lake package on the classpath "
            "(spark.jars.packages / spark.sql.extensions); use fmt='parquet' otherwise"
        )


def write_mart(
    df: DataFrame,
    root: str,
    table: str,
    fmt: str = "parquet",
    partition_by: list[str] | None = None,
    version: str | None = None,
) -> str:
    """Gold mart. Delta needs its package on the classpath; the default is
    parquet in a versioned folder. ``partition_by`` on the mart's type column
    (``period_type`` / ``metric_type``) lets dashboard predicates prune
    partitions."""
    if fmt == "delta":
        require_delta(df.sparkSession)
        path = _join(root, table)
        w = df.write.format("delta").mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.save(path)
        return path
    return write_layer(df, root, table, partition_by, version, fmt)


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def list_versions(spark: SparkSession, root: str, table: str) -> list[str]:
    """Version folders ``<root>/<table>/v=<id>``, oldest first (ids start
    with a UTC timestamp, so name order is time order)."""
    fs, base = _fs_and_path(spark, _join(root, table))
    if not fs.exists(base):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(base) if st.isDirectory()]
    return [_join(root, table, n) for n in sorted(n for n in names if n.startswith("v="))]


def prune_versions(
    spark: SparkSession, root: str, table: str, keep: int, protect: set[str] | frozenset[str] = frozenset()
) -> list[str]:
    """Delete all but the newest ``keep`` versions of ``table``, never one in
    ``protect`` (e.g. the folders the catalog currently points to). Returns the
    deleted paths. Versioned writes make overwrites atomic; pruning keeps
    their storage bounded."""
    if keep < 1:
        raise ValueError("keep must be >= 1")
    versions = list_versions(spark, root, table)
    doomed = [v for v in versions[:-keep] if v.rstrip("/") not in {p.rstrip("/") for p in protect}]
    for v in doomed:
        fs, path = _fs_and_path(spark, v)
        fs.delete(path, True)
    return doomed
