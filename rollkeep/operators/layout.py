"""Fixed output layouts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the columns of a declared schema in order, each cast to its declared type."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def to_layout(df: DataFrame, mapping: Mapping[str, Column], schema: T.StructType) -> DataFrame:
    """Project to a layout; columns the mapping does not name become typed nulls."""
    unknown = set(mapping) - set(schema.names)
    if unknown:
        raise ValueError(f"not in the layout: {sorted(unknown)}")
    return df.select(
        *[mapping.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def pad(df: DataFrame, name: str, type_name: str = "string", literal=None) -> DataFrame:
    return df.withColumn(name, F.lit(literal).cast(type_name))


def alias_copy(df: DataFrame, source: str, target: str) -> DataFrame:
    return df.withColumn(target, F.col(source))
