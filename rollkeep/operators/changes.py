"""What changed since the last filing, and which codes each side lacks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollkeep.operators.sets import missing


def diff_against_sent(current: DataFrame, sent: DataFrame, key: str, address_columns: Sequence[str]) -> DataFrame:
    """Status per key: ``ADD`` when it was never sent, ``ADDRESS`` when an address column differs
    (two unknown values are the same), ``CANCEL`` when it is gone. Unchanged keys give no row.

    Address columns come from the current row, or from the sent one for a cancelled key. Both
    inputs hold one address per key, in one row or in equal ones; a second address stops the job.
    """
    columns = list(address_columns)

    def single(rows: DataFrame, name: str, value: str) -> DataFrame:
        address = F.struct(*columns)
        grouped = rows.groupBy(F.col(key).alias(name)).agg(F.min(address).alias("_lo"), F.max(address).alias("_hi"))
        stop = F.raise_error(F.concat(F.lit("more than one address for "), F.col(name).cast("string")))
        return grouped.select(name, F.when(~F.col("_lo").eqNullSafe(F.col("_hi")), stop).otherwise(F.col("_lo")).alias(value))

    new, old = single(current, "_key", "_new"), single(sent, "_old_key", "_old")
    both = new.join(old, F.col("_key") == F.col("_old_key"), "full")
    same = F.lit(True)
    for name in columns:
        same = same & F.col(f"_new.{name}").eqNullSafe(F.col(f"_old.{name}"))
    status = (
        F.when(F.col("_old_key").isNull(), F.lit("ADD"))
        .when(F.col("_key").isNull(), F.lit("CANCEL"))
        .when(~same, F.lit("ADDRESS"))
    )
    return (
        both.withColumn("status", status)
        .where(F.col("status").isNotNull())
        .select(
            F.coalesce("_key", "_old_key").alias(key),
            *[
                F.when(F.col("status") == "CANCEL", F.col(f"_old.{c}")).otherwise(F.col(f"_new.{c}")).alias(c)
                for c in columns
            ],
            "status",
        )
    )


def reconcile(ours: DataFrame, theirs: DataFrame, key: str) -> DataFrame:
    """Codes only one side has: ``missing`` when we lack it, ``extra`` when they do."""
    lacking = missing(theirs, ours, [key]).withColumn("side", F.lit("missing"))
    surplus = missing(ours, theirs, [key]).withColumn("side", F.lit("extra"))
    return lacking.unionByName(surplus)
