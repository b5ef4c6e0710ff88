"""Session helpers: recommended configuration and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter for the plans in this package.  They are applied by
# ``tune`` and by ``build_session``; a cluster may set them in its defaults instead.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join partition even when that costs one extra shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # joins on (batch, product[, date]) may reuse a partitioning on a key subset
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # counts, minima and maxima of stored tables from the files' footers (V2 scans only, see sources.tables.stored_scan)
    "spark.sql.parquet.aggregatePushdown": "true",
    # streaming state on local disk instead of the heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


# What one task takes in at most: its sorts and hash tables hold many times as many bytes, as files and shuffles are compressed.
# Splits and coalesced partitions that are smaller already stay as they are.
TASK_BYTES = 16 * 1024 * 1024
TASK_CONF = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")

TARGET_PARTITION_BYTES = 256 * 1024 * 1024


def scale_conf(input_bytes: int, total_cores: int) -> dict[str, str]:
    """Partition sizing for a cluster run over ``input_bytes`` of parquet on ``total_cores`` cores.

    Shuffles start with enough partitions for ~256 MB each (and at least 3 waves
    of tasks); AQE then coalesces small ones, so the same setting works for
    small and very large inputs.  Scan splits are 256 MB.  Example: 100 TB on
    8,000 cores -> 409,600 initial shuffle partitions, coalesced at run time.
    """
    parts = max(3 * total_cores, -(-input_bytes // TARGET_PARTITION_BYTES))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_PARTITION_BYTES),
        "spark.sql.files.maxPartitionBytes": str(TARGET_PARTITION_BYTES),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * TARGET_PARTITION_BYTES),
    }


def input_bytes(spark: SparkSession, path: str) -> int:
    """Total bytes under ``path`` on the session's file system (for ``scale_conf``)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return int(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength())


def size_for_input(spark: SparkSession, path: str, total_cores: int) -> dict[str, str]:
    """Apply ``scale_conf`` for the data under ``path`` to the running session; returns the settings."""
    conf = scale_conf(input_bytes(spark, path), total_cores)
    for key, value in conf.items():
        spark.conf.set(key, value)
    return conf


def tune(spark: SparkSession) -> SparkSession:
    """Apply ``RECOMMENDED_CONF`` to a running session."""
    for key, value in RECOMMENDED_CONF.items():
        spark.conf.set(key, value)
    return spark


def bound_tasks(spark: SparkSession, *paths: str) -> SparkSession:
    """Keep what a task takes in at ``TASK_BYTES``, so that its memory does not grow with the tables under ``paths``: Spark lets splits
    and coalesced shuffle partitions grow with the input to 128 and 64 MB first, and the number of partitions stays as set."""
    for key in TASK_CONF:
        if _bytes(spark.conf.get(key)) > TASK_BYTES:
            spark.conf.set(key, str(TASK_BYTES))
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    size = 0
    for path in map(jvm.org.apache.hadoop.fs.Path, paths):
        files = path.getFileSystem(conf)
        size += sum(files.getContentSummary(found.getPath()).getLength() for found in files.globStatus(path) or ())  # none: nothing to size
    parts = -(-size // TASK_BYTES)
    if parts > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    return spark


def _bytes(size: str) -> int:
    """A size of Spark's settings (``134217728``, ``128MB``, ``64k``) in bytes."""
    number, unit = re.fullmatch(r"(\d+)\s*([kmgtp]?)i?b?", size.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def build_session(master: str | None = None, app: str = "perishables",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Local/test session builder; on a cluster use the cluster's session and ``tune``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(RECOMMENDED_CONF)
    conf.update({
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        # remove reliable-checkpoint files once no DataFrame references them
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": os.environ.get("PERISHABLES_DRIVER_MEMORY", "8g"),
    })
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir`` (also the RDD checkpoint folder).

    The session setting is read first, so lineage cuts and intermediate tables
    land in the folder the cluster names.  Only a local session (tests) gets a private
    temporary folder when nothing is configured; on a cluster that is an error, as
    executors would each write to a disk of their own.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="perishables-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


def cut_lineage(df):
    """Reliable checkpoint into the scratch folder (survives lost executors; never a local checkpoint)."""
    scratch_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location below the scratch folder."""
    base = scratch_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
