"""Priority de-duplication of persons that keeps ties."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollkeep.operators.joins import hash_condition


def keep_best(df: DataFrame, key: str, ended: str, codes: Sequence[str]) -> DataFrame:
    """Per key: open rows before ended ones, else the latest end date; then the smallest first
    code, then the smallest second code among what is left.

    A row with a null code is never removed by that code's step, and rows without a key are
    left alone. The best values come from three nested reductions of ever fewer rows, each
    combined on the map side, so no task holds all rows of one key. The rows are then matched
    on (key, end date) in a single join.
    """
    if len(codes) != 2:
        raise ValueError("two code columns are expected")
    first, second = codes
    by_code = df.groupBy(F.col(key).alias("_k"), F.col(ended).alias("_e"), F.col(first).alias("_c")).agg(
        F.min(second).alias("_l")
    )
    by_end = (
        by_code.groupBy("_k", "_e")
        .agg(
            F.min("_c").alias("_c"),
            F.min_by("_l", "_c").alias("_l_best"),
            F.min(F.when(F.col("_c").isNull(), F.col("_l"))).alias("_l_null"),
        )
        .select("_k", "_e", "_c", F.least("_l_best", "_l_null").alias("_l"))
    )
    is_open = F.col("_e").isNull()
    pick = F.struct("_c", "_l")
    best = (
        by_end.groupBy("_k")
        .agg(
            F.bool_or(is_open).alias("_open"),
            F.max("_e").alias("_e"),
            F.first(F.when(is_open, pick), ignorenulls=True).alias("_p_open"),
            F.max_by(pick, F.col("_e")).alias("_p_end"),
        )
        .select(
            "_k",
            F.when(~F.col("_open"), F.col("_e")).alias("_e"),
            F.when(F.col("_open"), F.col("_p_open")).otherwise(F.col("_p_end")).alias("_p"),
        )
        .select("_k", "_e", F.col("_p._c").alias("_c"), F.col("_p._l").alias("_l"), F.lit(True).alias("_hit"))
    )
    on = (F.col(key) == F.col("_k")) & F.col(ended).eqNullSafe(F.col("_e"))
    joined = df.join(best, on & hash_condition(df, [key], ["_k"]), "left")
    keep = F.col("_hit") & (
        (F.col(first).isNull() | F.col("_c").isNull() | (F.col(first) == F.col("_c")))
        & (F.col(second).isNull() | F.col("_l").isNull() | (F.col(second) == F.col("_l")))
    )
    return joined.where(F.col(key).isNull() | F.coalesce(keep, F.lit(False))).select(*df.columns)
