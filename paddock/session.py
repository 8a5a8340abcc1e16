"""Spark session defaults and the shared checkpoint folder.

All reports are written so that they do not depend on the session time zone
(every timestamp is ``timestamp_ntz``), but a session built here pins UTC anyway
so that ISO-8601 text with an offset is parsed the way the loaders expect.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings that matter at scale; the local defaults only shrink the shuffle width.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Runtime re-plan: a join side whose *measured* shuffle output is below this
    # threshold becomes a broadcast; anything larger stays a sort-merge join.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # No broadcast from static size estimates (unreliable on derived sides); only
    # the measured runtime size above decides.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    # Dynamic partition pruning even when the filtering side is not a broadcast
    # (static broadcasts are off): a session-partitioned telemetry scan only reads
    # the sessions the other side of the join keeps.
    "spark.sql.optimizer.dynamicPartitionPruning.reuseBroadcastOnly": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# What a 1000-executor cluster reading ~100 TB would add on top of SCALE_CONF (applied by
# ``get_spark(cluster=True)`` or the cluster's own defaults). Scan splits of 256 MB keep the
# task count near 400k; the shuffle starts wide and AQE coalesces toward 256 MB partitions and
# splits skewed ones; Kryo and a larger broadcast timeout suit wide joins.
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": "256MB",
    "spark.sql.shuffle.partitions": "40000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256MB",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1GB",
    "spark.sql.broadcastTimeout": "900",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.sql.parquet.aggregatePushdown": "true",
}


def get_spark(app: str = "paddock", cpus: int | str = "*", shuffle_partitions: int | None = None,
              driver_memory: str | None = None, extra: dict | None = None,
              cluster: bool = False) -> SparkSession:
    """Build (or reuse) a session with the scale settings above.

    ``shuffle_partitions`` defaults to the local core count; on a cluster pass a
    value sized so one shuffle partition stays around 128-256 MB.
    """
    builder = SparkSession.builder.appName(app)
    conf = dict(SCALE_CONF)
    if cluster:  # the master comes from spark-submit
        conf.update(CLUSTER_CONF)
    else:
        builder = builder.master(f"local[{cpus}]")
        n = shuffle_partitions or (os.cpu_count() if cpus == "*" else int(cpus))
        conf["spark.sql.shuffle.partitions"] = str(n)
    if driver_memory:
        conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_FALLBACK: dict[str, str] = {}  # by application: the folder used where none is set


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster names it; only when it is unset (tests) is ``fallback`` used, and
    remembered for the application. The folder is registered with the SparkContext
    so ``DataFrame.checkpoint()`` cuts lineage into reliable storage.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None)
    app = spark.sparkContext.applicationId
    if not path:
        if fallback is None and app not in _FALLBACK:
            raise RuntimeError("spark.checkpoint.dir is not set and no fallback was given")
        path = _FALLBACK.setdefault(app, fallback)
    spark.sparkContext.setCheckpointDir(path)
    return path
