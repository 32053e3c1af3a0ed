"""Set operations with SQL set semantics (nulls count as equal)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_distinct(*frames: DataFrame) -> DataFrame:
    """Union by position without duplicates."""
    return reduce(DataFrame.union, frames).distinct()


def missing(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct tuples of the left side that the right side lacks."""
    return left.select(*columns).subtract(right.select(*columns))
