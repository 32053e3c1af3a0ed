"""Grouped counts, roll-ups and the fallback location choice."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollkeep.functions.predicates import like
from rollkeep.operators.joins import inner


def count_when(condition: Column) -> Column:
    """Rows that meet a condition; unknown counts nowhere."""
    return F.count_if(condition)


def rollup_counts(df: DataFrame, levels: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    """Roll-up with ``level`` = how many of ``levels`` a row is summed over (0 = detail).

    The measures are additive (counts and sums): the detail groups are built first, so the
    expansion to all levels runs over groups and not over the input rows.
    """
    detail = df.groupBy(*levels).agg(*[measure.alias(name) for name, measure in aggs.items()])
    summed_over = F.lit(0)
    for name in levels:
        summed_over = summed_over + F.grouping(name).cast("int")
    return detail.rollup(*levels).agg(*[F.sum(name).alias(name) for name in aggs], summed_over.alias("level"))


def subtotals(rolled: DataFrame, level: int) -> DataFrame:
    """Rows summed over at least ``level`` of the levels: subtotals and, with them, the grand total."""
    return rolled.where(F.col("level") >= level).drop("level")


def agg_min(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(column).alias(column))


def agg_max(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.max(column).alias(column))


def duplicated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur on more than one row, with their row count ``n``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def distinct_tuples(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()


def row_count(df: DataFrame) -> DataFrame:
    """One row with the number of rows ``n``."""
    return df.agg(F.count(F.lit(1)).alias("n"))


def location_kinds(pattern: str = "%REMOTE%", blank_address_ok: bool = True) -> tuple[Column, Column]:
    """Conditions for an office and for a remote location that may be filed."""
    remote = like("descr", pattern, fold_case=True)
    return ~remote, remote if blank_address_ok else remote & (F.col("address1") != " ")


def choose_location(
    counts: DataFrame, locations: DataFrame, pattern: str = "%REMOTE%", blank_address_ok: bool = True
) -> DataFrame:
    """One location per company: the smallest that is not remote, or the smallest remote one
    where all are remote. A location without a description is neither.

    One grouped pass gives both candidates. With ``blank_address_ok=False`` a remote location
    whose first address line is blank or unknown is no candidate.
    """
    joined = inner(counts.select("company", "location"), locations.select("location", "descr", "address1"), ["location"])
    office, remote = location_kinds(pattern, blank_address_ok)
    picked = joined.groupBy("company").agg(
        F.min(F.when(office, F.col("location"))).alias("_office"),
        F.min(F.when(remote, F.col("location"))).alias("_remote"),
    )
    chosen = picked.select("company", F.coalesce("_office", "_remote").alias("location"))
    return chosen.where(F.col("location").isNotNull() & F.col("company").isNotNull())
