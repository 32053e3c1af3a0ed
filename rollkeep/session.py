"""Session settings, and a local session for checks and the bench."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


# Adaptive settings the plans rely on for skewed keys. The last one lets Spark split a skewed
# join although a later join would have reused its partitioning.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Set the adaptive settings on a session, cluster or local."""
    for name, value in ADAPTIVE.items():
        spark.conf.set(name, value)
    return spark


def local_session(name: str, cores: int | None = None) -> SparkSession:
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # no call sites: faster plan building
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)
