"""Session construction and the runtime settings every plan relies on."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the plans are designed around.  AQE re-plans joins
# with measured sizes (a runtime-checked broadcast), splits skewed join
# partitions even when that adds an exchange (a hot person may hold a third
# of all claims), and coalesces small shuffle partitions.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Sizing for ~100 TB inputs on a large cluster: 512 MB scan splits (about
# 200k tasks per full pass), AQE starting from many shuffle partitions and
# coalescing them toward 256 MB, skew split above 1 GB / 5x the median, and a
# 64 MB broadcast ceiling (AQE measures the real size before broadcasting).
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "40000",
    "spark.sql.shuffle.partitions": "40000",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "cohortlens", extra: dict | None = None,
                  profile: str = "local") -> SparkSession:
    """Local or cluster session with the UI off and the runtime settings on.

    ``profile="cluster"`` adds CLUSTER_CONF (and ignores ``shuffle_partitions``)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.driver.memory": os.environ.get("COHORTLENS_DRIVER_MEMORY", "16g"),
        **RUNTIME_CONF,
        **(CLUSTER_CONF if profile == "cluster" else {}),
        **(extra or {}),
    }
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session, on request (idempotent)."""
    for k, v in RUNTIME_CONF.items():
        spark.conf.set(k, v)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; where that is
    unset, a folder below the session's (shared) warehouse."""
    return spark.conf.get("spark.checkpoint.dir", None) or \
        spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder, set to ``shared_folder`` if unset."""
    path = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to a new folder of the shared store and read it
    back: what is built on it evaluates ``df`` once and survives lost executors."""
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
