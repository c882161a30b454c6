"""Session settings shared by jobs, tests and the benchmark."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings every job relies on: ANSI errors are avoided with try_* functions,
# dates are compared in UTC, AQE re-plans joins and coalesces partitions.
DEFAULT_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "fundspark",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the settings above.

    ``shuffle_partitions`` is only set when given: what spark-submit or the
    cluster's defaults say stays in force otherwise.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session (set by the cluster).
    Only when it is unset, as in tests, ``fallback`` is used and registered.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return current
    try:  # a classic session may name it on the context only
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        if jdir.isDefined():
            return jdir.get()
    except Exception:  # e.g. a Spark Connect session has no local context
        pass
    if fallback is None:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a shared folder is required on a cluster"
        )
    if "://" not in fallback:
        os.makedirs(fallback, exist_ok=True)
    try:
        spark.sparkContext.setCheckpointDir(fallback)
    except Exception:
        pass
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


def cluster_conf(
    input_bytes: int,
    cores: int,
    target_partition_bytes: int = 256 * 1024**2,
    max_partitions: int = 100_000,
) -> dict[str, str]:
    """Size shuffles and splits for an input of ``input_bytes`` on ``cores`` executor cores.

    Shuffle partitions start at input / target (a shuffle carries at most
    about the input after pruning), at least two waves of the cores, and at
    most ``max_partitions``: beyond that the shuffle's block count (map tasks
    x reduce partitions) costs more than larger partitions, which reduce
    tasks sort with spilling. AQE then coalesces small partitions and splits
    skewed ones at runtime. Scans read ``target_partition_bytes`` per task.
    For 100 TB on 8,000 cores: 100,000 shuffle partitions (about 1 GB each
    before AQE) and 256 MB splits.
    """
    partitions = min(max(2 * cores, -(-int(input_bytes) // target_partition_bytes)), max(max_partitions, 2 * cores))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024**2),
    }
