"""Session settings the library relies on. No master, no credentials, no cluster sizes."""

from __future__ import annotations

from pyspark.sql import SparkSession

SESSION_SETTINGS = {
    # Hours feed the solar formula, so the zone is part of the result.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # REBALANCE before a partitioned write: AQE splits the hot city and merges the small ones.
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    # The finer Gold folders hold few bytes each: one task per core writes them, not one task per 256 MB.
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.parquet.filterPushdown": "true",
    # Stream dedup keeps one key per observation: state on disk, not on the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(app_name: str = "solvind", master: str | None = None, **settings: str) -> SparkSession:
    """Get or create a session. `settings` keys use `__` for `.` (`spark__ui__enabled="false"`)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the zone on a session somebody else built."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark
