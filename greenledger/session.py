"""Session construction and the shared working folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job of this library assumes. ANSI mode stays on (Spark 4
# default): raw text is typed with try_cast, never with a bare cast.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Call-site capture for error messages costs JVM round trips on every
    # DataFrame/Column call while plans are being built.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


# Settings for a large cluster (e.g. 1000 executors, ~100 TB input); apply
# with spark-submit --conf. Partition counts follow bytes, not rows: AQE
# starts from many shuffle partitions and coalesces toward the advisory
# size, and splits skewed partitions in joins and rebalances.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "40000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.shuffle.partitions": "20000",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "greenledger", driver_memory: str | None = None) -> SparkSession:
    """Return (or create) a session with the library's base settings.

    On a cluster the master and sizing come from spark-submit; ``master`` is
    only for local runs and tests.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in BASE_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:  # local mode: the executors live in the driver JVM
        builder = builder.config("spark.driver.memory", driver_memory)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession, *parts: str) -> str:
    """A folder under the cluster's shared checkpoint directory.

    The cluster names its shared folder in ``spark.checkpoint.dir``. Only when
    that is unset and the master is local (tests, one machine) is a private
    folder created and registered; on a cluster that is an error, because
    executors would write to disks that the others can't read.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="greenledger-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return os.path.join(root, *parts) if parts else root
