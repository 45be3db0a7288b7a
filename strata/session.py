"""Session factory.

The settings here are the ones the operators rely on for correct results
(UTC session zone, ANSI mode) plus the adaptive-execution switches that let
Spark re-plan joins and aggregates at run time (broadcast when a side turns
out small, split skewed shuffle partitions, coalesce small ones).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

BASE_CONF = {
    # Dates derived from instants depend on the session zone: pin it.
    "spark.sql.session.timeZone": "UTC",
    # Spark 4 default; lenient conversions use explicit try_* functions.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot key holding a large share of rows must not pin one task.
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    app_name: str = "strata",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
    packages: list[str] | None = None,
    large_state: bool = False,
) -> SparkSession:
    """Build (or reuse) a session with the library's required settings.

    ``master`` and ``shuffle_partitions`` are left to the cluster unless given;
    on a large cluster size ``spark.sql.shuffle.partitions`` so a partition is
    a few hundred MB, AQE coalesces from there.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(BASE_CONF)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if large_state:
        # Streaming state kept off the JVM heap, checkpointed as changelogs:
        # the choice for joins and windows whose state outgrows executor
        # memory. (For small state the default in-heap store is faster.)
        settings[
            "spark.sql.streaming.stateStore.providerClass"
        ] = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        settings["spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"] = "true"
    if packages:
        # e.g. the topic connector for read_event_stream(fmt="kafka")
        settings["spark.jars.packages"] = ",".join(packages)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    for key in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled"):
        spark.conf.set(key, settings[key])
    spark.sparkContext.setLogLevel("WARN")
    checkpoint_root(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staging tables.

    Read from ``spark.checkpoint.dir``. Only a local session (tests, bench)
    gets a private scratch folder when the setting is absent; on a cluster a
    machine-local folder would vanish with the executor, so it is an error.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(
        CHECKPOINT_CONF, None
    )
    if not root:
        if not _is_local(spark):
            raise RuntimeError(f"{CHECKPOINT_CONF} must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="strata-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, root)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(os.path.join(root, "rdd"))
    return root
