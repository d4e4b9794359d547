"""Session settings the jobs rely on. Master, memory, storage endpoints and
credentials come from spark-submit / spark-defaults, never from here."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Size reducers by bytes, not by core count: AQE merges small partitions
    # up to the advisory size.
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    # State of the streaming dedup lives off the JVM heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

# Reducers that AQE starts from where nobody set spark.sql.shuffle.partitions: enough
# for hundreds of terabytes, merged down to the advisory size for less.
INITIAL_PARTITIONS = 8192

DELTA = {
    "spark.sql.extensions": "io.delta.sql.DeltaSparkSessionExtension",
    "spark.sql.catalog.spark_catalog": "org.apache.spark.sql.delta.catalog.DeltaCatalog",
}


def build_session(
    app_name: str,
    *,
    delta: bool = False,
    conf: Mapping[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for settings in (DEFAULTS, DELTA if delta else {}, conf or {}):
        for key, value in settings.items():
            builder = builder.config(key, value)
    spark = builder.getOrCreate()
    chosen = spark.sparkContext.getConf().contains("spark.sql.shuffle.partitions")
    if not chosen and "spark.sql.shuffle.partitions" not in (conf or {}):
        initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
        spark.conf.set(initial, str(INITIAL_PARTITIONS))
    return spark
