"""Session construction and the shared scratch location.

On a cluster the scratch root is whatever the cluster names in
``spark.checkpoint.dir`` (a shared file system every executor can reach). Only
a local session without that setting gets a private temporary folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every session of this library wants. AQE re-plans joins and shuffle
# partition counts at run time and splits skewed partitions of sort-merge joins.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def cluster_conf(total_cores: int, input_bytes: int | None = None) -> dict[str, str]:
    """Settings for a large cluster (e.g. 1000 executors reading ~100 TB).

    Shuffles start with enough partitions for ~128 MB each at the given input
    size (at least 3 per core, at most 100k) and AQE coalesces the small ones and splits
    skewed ones at run time; scans split files at 128 MB; a join side is only
    broadcast when AQE measures it under 64 MB.
    """
    parts = 3 * total_cores
    if input_bytes:
        # shuffled bytes are far below scanned bytes after pruning; cap the map-status cost
        parts = min(max(parts, int(input_bytes // (128 << 20))), 100_000)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(16 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.files.maxPartitionBytes": str(128 << 20),
        "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    }


def get_spark(
    master: str | None = None,
    app_name: str = "nimbus",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    ``master`` is left to ``spark-submit`` when None, which is what a cluster
    job wants; tests pass ``local[*]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if master and not master.startswith("local"):
        settings.update(cluster_conf(int(os.environ.get("NIMBUS_TOTAL_CORES", "8000"))))
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints, stream state and written tables.

    Read from the session (``spark.checkpoint.dir``). When it is unset, a local
    session gets a fresh temporary folder; a cluster session must have it set,
    because a folder on one machine is invisible to the executors.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a cluster job needs a shared folder for "
            "checkpoints and intermediate tables"
        )
    root = tempfile.mkdtemp(prefix="nimbus-checkpoint-")
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir() or root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique sub-folder of the checkpoint root for one job's output."""
    return os.path.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def materialised(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once into the shared scratch folder and read back: what is used several
    times runs once, and a lost executor costs a re-read."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
