"""Session helpers: a local session for tests/bench, and the shared
checkpoint folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession


# Settings for a large cluster (hundreds of executors, ~100 TB of inputs).
# Shuffles start wide and AQE coalesces them to ~advisory size, so one
# partition never holds more than a few hundred MB whatever the day's volume;
# skewed partitions (one hot item, order or day) are split at runtime.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    # static broadcast only for truly small sides; AQE may still broadcast a
    # side whose materialised size is under the runtime threshold
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "128m",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
}


# The recommendation chain joins and windows on item (plus region, week, FC or
# date): letting those operators reuse an item partitioning removes about a
# third of its shuffles. It is scoped to that run because, session-wide, the
# same setting could also leave a join partitioned by a low-cardinality key.
ITEM_COPARTITION_CONF = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}


@contextmanager
def session_conf(spark: SparkSession, conf: dict):
    """Set runtime SQL settings for the duration of a block, then restore."""
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield spark
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def apply_cluster_conf(spark: SparkSession, overrides: dict | None = None) -> SparkSession:
    """Apply ``CLUSTER_CONF`` (runtime SQL settings only) to a session."""
    for k, v in {**CLUSTER_CONF, **(overrides or {})}.items():
        spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def local_session(cpus: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("restock")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (spark.checkpoint.dir).
    Only when it is unset on a local master (tests) is a scratch folder made;
    elsewhere that would be a disk the executors don't share, so it is an error."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="restock-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no SparkContext
        return d
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder for staged tables."""
    base = ensure_checkpoint_dir(spark)
    import uuid
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")
