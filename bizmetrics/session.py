"""Session settings the reports rely on. On a cluster, pass the same ones to spark-submit."""

from __future__ import annotations

from pyspark.sql import SparkSession

# What matters for results, for skew and for broadcasts; sizes of executors and shuffles are
# the cluster's business (AQE picks the number of reduce tasks).
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # No join carries a hint: Spark broadcasts a side only after checking its size against
    # this, and otherwise sorts and merges, with hot partitions split by AQE. A dimension of
    # this size (compressed; some ten times that in memory) is worth sending out in place of
    # shuffling the fact.
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cores: int | str = "*", app: str = "bizmetrics", **extra: str) -> SparkSession:
    """A local session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
