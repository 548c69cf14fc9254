"""Session settings the plans are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# No plan forces a broadcast. Spark picks one only from measured sizes (the
# table statistics, or shuffle sizes seen by AQE) and otherwise sort-merges,
# splitting partitions of hot keys.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.ui.enabled": "false",
}

# On a cluster AQE merges small partitions, so start high; local runs start low.
CLUSTER_SHUFFLE_PARTITIONS = 20000


def build_session(
    app_name: str = "lanewright",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **extra: str,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    local = master is not None and master.startswith("local")
    if master is not None:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if shuffle_partitions is None:
        shuffle_partitions = 8 if local else CLUSTER_SHUFFLE_PARTITIONS
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
