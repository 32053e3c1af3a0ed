"""Numbered versions of a set of tables in one folder.

A version is written table by table and seen when its last step, a mark beside the tables, is there, so a
writer that fails leaves the version before in place. A number that is written again, as when a run is repeated,
replaces its earlier version. Old versions are dropped by age, never the newest one.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Version:
    """A version that is being written, or is complete."""

    spark: SparkSession
    number: int
    folder: str
    completed: int = 0  # when its mark was written, in milliseconds

    def write(self, table: str, rows: DataFrame) -> DataFrame:
        rows.write.parquet(f"{self.folder}/{table}")
        return self.read(table)

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{table}")

    def complete(self) -> None:
        self.spark.range(1).write.parquet(f"{self.folder}/complete")


def versions(spark: SparkSession, path: str) -> list[Version]:
    """The complete versions, oldest number first; of one number the one completed last."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/version=*/complete/_SUCCESS")
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place) or []
    by_number: dict[int, Version] = {}
    for status in found:
        folder = status.getPath().getParent().getParent().toString()
        number = int(re.search(r"version=(\d+)", folder.rsplit("/", 1)[1])[1])
        one = Version(spark, number, folder, status.getModificationTime())
        if number not in by_number or one.completed >= by_number[number].completed:
            by_number[number] = one
    return [by_number[number] for number in sorted(by_number)]


def newest(spark: SparkSession, path: str, below: int | None = None) -> Version | None:
    """The complete version with the highest number, of those below a number if one is given."""
    fitting = [v for v in versions(spark, path) if below is None or v.number < below]
    return fitting[-1] if fitting else None


def new_version(spark: SparkSession, path: str, number: int | None = None) -> Version:
    """A version to write; without a number the one after the newest."""
    if number is None:
        last = newest(spark, path)
        number = last.number + 1 if last else 1
    return Version(spark, number, f"{path}/version={number:012d}-{uuid.uuid4().hex}")


def drop_versions(spark: SparkSession, path: str, before: dt.datetime) -> list[int]:
    """Delete the versions that were completed before a time, and what unfinished or replaced ones have left since then;
    the newest version stays whatever its age. Returns the numbers of complete versions that went."""
    complete = versions(spark, path)
    kept = {v.folder for v in complete if v.completed >= before.timestamp() * 1000} | {v.folder for v in complete[-1:]}
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/version=*")
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in store.globStatus(place) or []:
        if status.getPath().toString() not in kept and status.getModificationTime() < before.timestamp() * 1000:
            store.delete(status.getPath(), True)
    return [v.number for v in complete if v.folder not in kept]
