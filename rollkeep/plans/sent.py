"""How often an ended coverage was sent: a table by member and coverage that every run folds forward.

The state after run N is a version of its own, made from the state before N and what N sends. A run that is repeated
starts from the same state, so it counts once. What counts as one termination is inferred: as long as the same end date
is sent, the count goes on; another end date starts at one; a coverage that is sent open again is forgotten.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollkeep.operators import joins
from rollkeep.sources.versions import new_version, newest

KEYS = ("subscriber_id", "member_seq", "coverage_seq")


def fold_sent(state: DataFrame, sent: DataFrame, keys: Sequence[str] = KEYS, ended: str = "benefit_end") -> DataFrame:
    """The state after a run: keys, the end date that was sent and how often (``times_sent``).

    A key that a run sends several times counts once, with its last end date; if one of the rows is open, it is open.
    """
    once = sent.groupBy(*keys).agg(
        F.max(ended).alias("_end"), F.bool_or(F.col(ended).isNull()).alias("_open")
    )
    now = once.select(*[F.col(k).alias(f"_now_{k}") for k in keys], "_end", "_open", F.lit(True).alias("_sent"))
    same = [F.col(k).eqNullSafe(F.col(f"_now_{k}")) for k in keys]
    both = state.join(now, same, "full")
    again = F.when(F.col(ended) == F.col("_end"), F.coalesce("times_sent", F.lit(0))).otherwise(0) + 1
    sent_now = F.coalesce("_sent", F.lit(False))
    folded = both.where(~sent_now | ~F.col("_open"))
    return folded.select(
        *[F.when(sent_now, F.col(f"_now_{k}")).otherwise(F.col(k)).alias(k) for k in keys],
        F.when(sent_now, F.col("_end")).otherwise(F.col(ended)).alias(ended),
        F.when(sent_now, again).otherwise(F.col("times_sent")).cast("long").alias("times_sent"),
    )


def sent_before(spark: SparkSession, path: str, run: int, like: DataFrame, keys: Sequence[str] = KEYS, ended: str = "benefit_end") -> DataFrame:
    """The state before a run; empty, with the columns that ``like`` gives it, before the first."""
    version = newest(spark, path, below=run)
    if version is not None:
        return version.read("sent")
    return like.select(*keys, ended, F.lit(0).cast("long").alias("times_sent")).where("false")


def record_sent(sent: DataFrame, path: str, run: int, keys: Sequence[str] = KEYS, ended: str = "benefit_end") -> DataFrame:
    """Fold what a run sends into the ledger at ``path``; the state after it."""
    spark = sent.sparkSession
    version = new_version(spark, path, run)
    state = version.write("sent", fold_sent(sent_before(spark, path, run, sent, keys, ended), sent, keys, ended))
    version.complete()
    return state


def with_times_sent(rows: DataFrame, state: DataFrame, keys: Sequence[str] = KEYS, ended: str = "benefit_end") -> DataFrame:
    """Add how often the row's termination was sent before: never, if it is open or ends on another day."""
    known = state.select(*keys, F.col(ended).alias("_sent_end"), F.col("times_sent").alias("_times"))
    joined = joins.left(rows.drop("times_sent"), known, list(keys))
    times = F.when(F.col(ended) == F.col("_sent_end"), F.col("_times"))
    return joined.withColumn("times_sent", F.coalesce(times, F.lit(0)).cast("long")).drop("_sent_end", "_times")
