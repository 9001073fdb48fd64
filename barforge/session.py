"""Session settings the engine relies on."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

# Settings every job of this engine assumes. The values tuned to a cluster
# (partition counts, broadcast threshold, memory) are left to the
# deployment; these are about semantics and adaptivity.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Remove reliable checkpoint files once their DataFrame is unreachable.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Starting points for a large cluster (100 TB class), applied with
# ``get_spark(conf=CLUSTER_CONF)``: AQE coalesces the many initial shuffle
# partitions to ~256 MB each and splits skewed ones; scans read 256 MB
# splits; a side is broadcast only when AQE measured it under 64 MB.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_spark(master: str | None = None, app: str = "barforge",
              shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    """Get or create a session with ``ENGINE_CONF`` applied."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = dict(ENGINE_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir``."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    return spark.conf.get("spark.checkpoint.dir", None) or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the session's checkpoint folder. Only a local-mode session (tests)
    without one gets a fresh scratch folder; on a cluster a machine-local
    folder would be wrong, so a missing setting is an error there."""
    d = checkpoint_dir(spark)
    if not d:
        # "local-cluster[...]" has executors of its own.
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster "
                               "(HDFS or an object store); it holds intermediate results")
        d = tempfile.mkdtemp(prefix="barforge-ckpt-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir()
