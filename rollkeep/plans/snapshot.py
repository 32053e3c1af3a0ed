"""Full refresh of the member snapshot from two sources."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollkeep.operators import joins
from rollkeep.sources.versions import drop_versions, new_version, newest


def refresh_snapshot(source1: DataFrame, source2: DataFrame, group_lookup: DataFrame, path: str) -> DataFrame:
    """Replace the snapshot at ``path`` and report the rows of each stage.

    Both sources have the same columns with ``company`` among them; ``group_lookup`` has one
    ``group_number`` per company, and a member without one keeps a null. Each refresh writes a
    version of its own, so a refresh that fails leaves the one before in place. Older versions stay until
    :func:`drop_snapshots`, so the sources may read from ``path``.
    """
    version = new_version(source1.sparkSession, path)
    groups = version.write("groups", group_lookup).select("company", "group_number")
    first = source1.withColumn("source", F.lit("first"))
    second = source2.withColumn("source", F.lit("second"))
    both = joins.lookup_one(first.unionByName(second), groups, ["company"], "group_number", "group_number")
    written = version.write("members", both)
    version.complete()
    stages = written.groupBy(F.col("source").alias("stage")).agg(
        F.count(F.lit(1)).alias("rows"), F.count("group_number").alias("grouped")
    )
    lookup = groups.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit("groups").alias("stage"), "rows", F.col("rows").alias("grouped")
    )
    return stages.unionByName(lookup)


def read_snapshot(spark: SparkSession, path: str, table: str = "members") -> DataFrame:
    """``members`` or ``groups`` of the newest complete refresh."""
    version = newest(spark, path)
    if version is None:
        raise FileNotFoundError(f"no complete snapshot below {path}")
    return version.read(table)


def drop_snapshots(spark: SparkSession, path: str, before: dt.datetime) -> list[int]:
    """Delete the refreshes completed before a time, but for the newest."""
    return drop_versions(spark, path, before)
