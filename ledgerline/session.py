"""SparkSession construction and cluster-facing settings."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ledgerline.sources.work import configured_dir

# Settings every ledgerline job relies on. ANSI stays on so an unsafe cast fails
# loudly; the cleaning code uses explicit try_* functions where the source rules
# want "bad value -> NULL".
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "ledgerline",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with ledgerline's settings applied.

    ``shuffle_partitions`` should be sized so one shuffle partition is
    ~128-256 MB at the target scale; AQE coalesces small ones at runtime.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in conf.items():
        if not k.startswith("spark.ui") and not k.startswith("spark.driver"):
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf of an already running session
                pass
    return spark


def cluster_conf(
    input_bytes: int, executors: int, cores_per_executor: int, shuffle_fraction: float = 0.1
) -> dict[str, str]:
    """Scale-dependent settings for a cluster run (pass as ``extra_conf``).

    * scan splits of 512 MB: 100 TB -> ~200k read tasks, a few waves on a
      1000-executor cluster, each task's columnar batch well inside memory;
    * an initial shuffle partition count sized for ~256 MB partitions of the
      expected shuffle volume, ``shuffle_fraction`` of the input: scans read
      few columns and partial aggregation collapses lines to orders before the
      first exchange (100 TB -> ~41k partitions, not one per 256 MB of input,
      which would mean ~10^10 shuffle blocks); at least 3 tasks per core. AQE
      coalesces small partitions to the 256 MB advisory size and splits skewed
      ones (> 5x the median and > 1 GB);
    * broadcast joins only below 64 MB measured size (static estimate or AQE
      runtime size), so a broadcast never grows with the data.
    """
    cores = max(1, executors * cores_per_executor)
    target = 256 * 1024**2
    initial = max(3 * cores, -(-int(input_bytes * shuffle_fraction) // target))
    return {
        "spark.sql.files.maxPartitionBytes": str(512 * 1024**2),
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1024**3),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024**2),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024**2),
    }


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for stream checkpoints: what ``spark.checkpoint.dir``
    names. There is no default: a stream that restarts with another folder
    would lose or repeat files."""
    configured = configured_dir(spark)
    if not configured:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (object store or distributed file system)")
    return configured
