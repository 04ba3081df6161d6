"""Session settings the operators are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution carries three of the design decisions: it turns a join into a broadcast only after the
# side's real size is known, it splits skewed join partitions, and it sizes shuffle partitions from real bytes.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    # Joins whose shuffled partitions all turned out this small hash instead of sorting.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.orc.filterPushdown": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str = "martline", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
