"""Session settings shared by the bench, the tests and batch jobs."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Re-plan at run time: join strategy, partition count and skewed join keys.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    # Long plans are built faster when calls do not record where they were made.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build(app: str = "farebox", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; the cluster's own values win when given in ``extra``.

    Shuffle partitions are left to the cluster (AQE merges small ones); local runs
    pass a number near their core count.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
