"""Explicit orders, row numbers and running totals over a whole table.

A window without a partition would pull the table into one task. Here the table is staged, range
partitioned on the order from there (the sample for the ranges reads the stage, so the input is
evaluated once), and staged again with each row's partition and place in it; every partition then
only needs the totals of the partitions before it: one row per partition. The number of partitions
follows the staged size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollkeep.sources.staging import discard, staged

Order = Sequence[tuple[str, bool, str] | str]


def order_columns(order: Order) -> list[Column]:
    """``(column, ascending, "first" or "last")`` to sort columns; a bare name means ascending,
    nulls last, the database default the feeds rely on."""
    columns = []
    for item in order:
        name, ascending, nulls = (item, True, "last") if isinstance(item, str) else item
        column = F.col(name)
        if ascending:
            columns.append(column.asc_nulls_last() if nulls == "last" else column.asc_nulls_first())
        else:
            columns.append(column.desc_nulls_last() if nulls == "last" else column.desc_nulls_first())
    return columns


def ordered(df: DataFrame, order: Order) -> DataFrame:
    return df.orderBy(*order_columns(order))


PARTITION_BYTES = 32 << 20


def partitions_for(table: DataFrame, target: int = PARTITION_BYTES) -> int:
    """Partitions of about ``target`` bytes for a staged table, whose size its files tell."""
    size = int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(1, -(-size // target))


def place_rows(df: DataFrame, order: Order) -> tuple[DataFrame, int]:
    """Rows range partitioned on the order and staged, with ``_part`` and ``_place`` (0, 1, ..) in it, and how many
    partitions there are."""
    columns = order_columns(order)
    base = staged(df, "unplaced")
    parts = partitions_for(base)
    ranged = base.repartitionByRange(parts, *columns).sortWithinPartitions(*columns)
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    placed = staged(ranged.select("*", F.spark_partition_id().alias("_part"), place.alias("_place")), "placed")
    discard(base)
    return placed, parts


def _before(placed: DataFrame, totals: Mapping[str, Column]) -> DataFrame:
    """Per partition, the totals over all earlier partitions. One row per partition."""
    per_part = placed.groupBy(F.col("_part").alias("_p")).agg(*[total.alias(name) for name, total in totals.items()])
    window = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    return per_part.select("_p", *[F.coalesce(F.sum(name).over(window), F.lit(0)).alias(name) for name in totals])


def number_rows(df: DataFrame, order: Order, name: str) -> DataFrame:
    """Consecutive numbers from 1 in the given order, which should be total."""
    placed, _ = place_rows(df, order)
    before = _before(placed, {"_n": F.count(F.lit(1))})
    joined = placed.join(F.broadcast(before), placed["_part"] == before["_p"])  # one row per partition
    return joined.select((F.col("_n") + F.col("_place") + 1).alias(name), *df.columns)


def running_before(df: DataFrame, order: Order, sums: Mapping[str, str]) -> DataFrame:
    """Add, for each ``new name: column``, the sum of the column over all earlier rows.

    The order should be total and free of one dominating value, so that the range partitions
    are even.
    """
    placed, _ = place_rows(df, order)
    totals = {f"_t_{name}": F.sum(column) for name, column in sums.items()}
    before = _before(placed, totals)
    inside = Window.partitionBy("_part").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    local = placed.select(
        "*", *[F.coalesce(F.sum(column).over(inside), F.lit(0)).alias(f"_l_{name}") for name, column in sums.items()]
    )
    joined = local.join(F.broadcast(before), local["_part"] == before["_p"])  # one row per partition
    return joined.select(*df.columns, *[(F.col(f"_l_{name}") + F.col(f"_t_{name}")).alias(name) for name in sums])
