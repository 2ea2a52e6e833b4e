"""Spark session helpers.

The library never creates a session behind the caller's back: every operator
takes a DataFrame.  ``get_spark`` is only used by tests, ``bench.py`` and the
command-line tools.  It turns on AQE (runtime coalescing, skew-join splitting,
runtime broadcast decisions) and keeps the Spark UI off.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def cluster_conf(input_tb: float = 100.0, executors: int = 1000, cores_per_executor: int = 8,
                 shuffle_partition_mb: int = 256) -> dict[str, str]:
    """Settings for a large cluster run, sized from the input volume.

    Scan splits of 512 MB keep ~200k scan tasks for 100 TB; the shuffle
    partition count is sized so a full shuffle of the input lands near
    ``shuffle_partition_mb`` per partition (AQE coalesces smaller stages and
    splits skewed ones); broadcast stays at the default-sized threshold so only
    genuinely small sides (measured at runtime by AQE) are broadcast.
    """
    shuffle_parts = max(2 * executors * cores_per_executor,
                        int(input_tb * 1024 * 1024 / shuffle_partition_mb))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{shuffle_partition_mb}m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
        "spark.sql.shuffle.partitions": str(shuffle_parts),
        "spark.sql.files.maxPartitionBytes": "512m",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.shuffle.service.enabled": "true",
        "spark.decommission.enabled": "true",
        "spark.storage.decommission.shuffleBlocks.enabled": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    }


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "cadence") -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "*")
    master = master or f"local[{cpus}]"
    if shuffle_partitions is None:
        shuffle_partitions = 8 if cpus == "*" else max(2, 2 * int(cpus))
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("CADENCE_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Return the checkpoint folder named by the session.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is.  Only a local-mode session without one (tests, bench) gets a fresh
    scratch folder.  A Spark Connect session keeps its server-side setting
    (returns the configured value, or None).
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: no driver-side context
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="cadence-ckpt-", dir="/tmp")
    sc.setCheckpointDir(path)
    return path


def materialize(df):
    """Write ``df`` to the session's reliable checkpoint folder and cut its lineage.

    Used before iterative work (model grids, CV folds) so every pass reads the
    materialised rows instead of recomputing upstream joins, and a lost
    executor costs a re-read, not a recomputation.  Never a local checkpoint.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
