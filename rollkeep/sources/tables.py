"""Base tables, declared staging tables and literal rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollkeep.operators.layout import typed

Tables = Mapping[str, DataFrame]


def scan(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def load_tables(spark: SparkSession, folder: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """A namespace of base tables; each is read only when a plan uses it."""
    return {name: scan(spark, folder, name) for name in names}


def insert_select(df: DataFrame, schema: T.StructType) -> DataFrame:
    """A typed staging insert: the select list is taken by position and cast to the declared types."""
    if len(df.columns) != len(schema.fields):
        raise ValueError("the select list and the declared columns differ in number")
    return typed(df.toDF(*schema.names), schema)


def code_list(spark: SparkSession, path: str, column: str = "company") -> DataFrame:
    """A list of codes, one per line; blank lines are skipped."""
    lines = spark.read.text(path).select(F.trim("value").alias(column))
    return lines.where(F.length(column) > 0)


def literal_rows(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    return spark.createDataFrame(rows, schema)
