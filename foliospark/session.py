"""Session settings the library is tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Options that matter at scale; a cluster may set its own first.
SETTINGS = {
    "spark.scheduler.mode": "FAIR",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = 8, memory: str = "8g", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("foliospark")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
