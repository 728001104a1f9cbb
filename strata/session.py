"""Session settings: a local session for tests, and the settings a cluster job wants."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# What the jobs rely on anywhere. UTC makes timestamps print the same on every host; AQE
# re-plans joins from real shuffle sizes, splits skewed partitions and merges small ones.
COMMON_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Joins in a chain on one key are split too, at the price of one more shuffle after a split.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# For a large cluster: many small shuffle partitions that AQE merges up to the advisory size,
# so that one partition fits one executor core's share of memory whatever the input size.
CLUSTER_CONF = {
    **COMMON_CONF,
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def local_session(app: str = "strata", cpus: int | str | None = None) -> SparkSession:
    """A one-machine session; used by the tests and the benchmark."""
    cpus = cpus or os.environ.get("BENCH_CPUS") or "8"
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in COMMON_CONF.items():
        builder = builder.config(key, value)
    spark = (
        builder.config("spark.sql.shuffle.partitions", str(cpus) if str(cpus).isdigit() else "8")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
