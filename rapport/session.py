"""Spark session defaults shared by the benchmark and the tests."""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE sizes shuffle partitions, converts joins whose measured size is small to
# broadcast, and splits skewed join partitions, so plans carry no join hints.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    # Call sites of column expressions are only read by error messages.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int | str = "*", app: str = "rapport", **extra: str) -> SparkSession:
    """A single-JVM session; on a cluster use the session you are given instead."""
    partitions = "8" if cores == "*" else str(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in {**DEFAULTS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
