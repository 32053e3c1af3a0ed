"""Joins and subquery forms of the feeds, all on equality keys.

Nothing here forces a broadcast: Spark broadcasts a side when its measured size is below
``spark.sql.autoBroadcastJoinThreshold`` and otherwise exchanges both sides on the keys,
where adaptive execution splits skewed partitions.

Adaptive splitting needs an exchange right below each side of the join. A right side that was
just grouped on the join keys has none, as it is partitioned that way already, and a key with
very many rows on the left would stay in one task. Joins against such a side therefore match
a hash of the keys too: that makes Spark exchange the (reduced) right side again, and the left
side can be split.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollkeep.functions.predicates import ColumnLike, DateLike, _col, as_date, valid_on
from rollkeep.operators.asof import latest_as_of

Keys = Sequence[str] | Mapping[str, str]


def _pairs(on: Keys) -> list[tuple[str, str]]:
    """Join keys as (left name, right name)."""
    return list(on.items()) if isinstance(on, Mapping) else [(key, key) for key in on]


def _condition(on: Keys) -> Column:
    """Equality of the left keys with the right ones, which carry names of their own by then."""
    return reduce(and_, [F.col(left) == F.col(f"_r{i}") for i, (left, _) in enumerate(_pairs(on))])


def hash_condition(df: DataFrame, keys: Sequence[str], right_keys: Sequence[str]) -> Column:
    """Equality of a hash of the keys, to go with the equality of the keys (see the module text).

    Left rows with a null key match nothing; they get a hash of the whole row instead, so that an
    outer join does not gather them all in one partition.
    """
    unknown = reduce(or_, [F.col(key).isNull() for key in keys])
    return F.when(unknown, F.xxhash64(*df.columns)).otherwise(F.xxhash64(*keys)) == F.xxhash64(*right_keys)


def _left_grouped(df: DataFrame, right: DataFrame, on: Keys, hot: bool = False) -> DataFrame:
    """Left join against a side that was grouped on the join keys.

    The left rows keep their partitioning by the keys from one such join to the next. ``hot`` is for keys that many
    rows share or that many rows lack: it takes an exchange of its own, which may be split.
    """
    if not hot:
        return df.join(right, _condition(on), "left")
    keys = [left for left, _ in _pairs(on)]
    hashes = hash_condition(df, keys, [f"_r{i}" for i in range(len(keys))])
    return df.join(right, _condition(on) & hashes, "left")


def _right_keys(other: DataFrame, on: Keys) -> list[Column]:
    return [F.col(right).alias(f"_r{i}") for i, (_, right) in enumerate(_pairs(on))]


def _renamed(other: DataFrame, on: Keys) -> DataFrame:
    """The right side with its keys renamed and its other columns as they are."""
    names = {right for _, right in _pairs(on)}
    return other.select(*_right_keys(other, on), *[F.col(c) for c in other.columns if c not in names])


def _result(df: DataFrame, right: DataFrame, on: Keys) -> list[str]:
    """All left columns and the right ones but the keys."""
    keys = {f"_r{i}" for i in range(len(_pairs(on)))}
    return df.columns + [c for c in right.columns if c not in keys]


def inner(df: DataFrame, other: DataFrame, on: Keys) -> DataFrame:
    """Equi-join; the right keys are dropped."""
    right = _renamed(other, on)
    return df.join(right, _condition(on), "inner").select(*_result(df, right, on))


def left(df: DataFrame, other: DataFrame, on: Keys, hot: bool = False) -> DataFrame:
    """Left join that keeps rows without a partner; the right keys are dropped. ``hot`` is for a right side that was
    grouped on its keys and a left side with hot ones."""
    right = _renamed(other, on)
    joined = _left_grouped(df, right, on, hot)
    return joined.select(*_result(df, right, on))


def semi(df: DataFrame, other: DataFrame, on: Keys) -> DataFrame:
    """Rows with a partner, as ``IN (subquery)`` and ``EXISTS`` keep them."""
    return df.join(other.select(*_right_keys(other, on)), _condition(on), "left_semi")


def anti(df: DataFrame, other: DataFrame, on: Keys) -> DataFrame:
    """Rows without a partner, as ``NOT EXISTS`` keeps them. Rows with a null key stay."""
    return df.join(other.select(*_right_keys(other, on)), _condition(on), "left_anti")


def flag_keys(df: DataFrame, other: DataFrame, on: Keys, name: str, hot: bool = False) -> DataFrame:
    """Add a boolean column: does the row's key occur on the right side."""
    right = other.select(*_right_keys(other, on)).distinct().select("*", F.lit(True).alias("_hit"))
    joined = _left_grouped(df, right, on, hot)
    return joined.select(*df.columns, F.coalesce("_hit", F.lit(False)).alias(name))


def in_keys(df: DataFrame, sets: Sequence[tuple[DataFrame, Keys]], mode: str = "and", hot: bool = False) -> DataFrame:
    """Rows whose keys occur in all of the key sets (``and``) or in any of them (``or``)."""
    if mode == "and":
        for other, on in sets:
            df = semi(df, other, on)
        return df
    if mode != "or":
        raise ValueError(f"unknown mode {mode!r}")
    flagged, hit = df, F.lit(False)
    for i, (other, on) in enumerate(sets):
        flagged = flag_keys(flagged, other, on, f"_in{i}", hot)
        hit = hit | F.col(f"_in{i}")
    return flagged.where(hit).select(*df.columns)


def not_in_flag(df: DataFrame, column: str, other: DataFrame, other_column: str, name: str, hot: bool = False) -> DataFrame:
    """Add the three-valued result of ``column NOT IN (select other_column ..)``.

    An empty list gives true. Otherwise a listed value gives false, and a null on the left or
    anywhere in the list gives null where the answer is not already false. The list is read as
    a set of distinct values plus two counts, so the row side needs one equi-join only.
    """
    on = {column: other_column}
    values = other.select(F.col(other_column).alias("_r0"))
    size = values.agg(F.count(F.lit(1))).scalar()
    nulls = values.agg(F.count_if(F.col("_r0").isNull())).scalar()
    listed = values.where(F.col("_r0").isNotNull()).distinct().withColumn("_listed", F.lit(True))
    answer = (
        F.when(size == 0, F.lit(True))
        .when(F.col("_listed"), F.lit(False))
        .when(F.col(column).isNull() | (nulls > 0), F.lit(None).cast("boolean"))
        .otherwise(F.lit(True))
    )
    joined = _left_grouped(df, listed, on, hot)
    return joined.select(*df.columns, answer.alias(name))


def null_aware_not_in(df: DataFrame, column: str, other: DataFrame, other_column: str, hot: bool = False) -> DataFrame:
    """Rows for which ``NOT IN`` is true."""
    return not_in_flag(df, column, other, other_column, "_out", hot).where("_out").drop("_out")


def valid_at(
    df: DataFrame,
    other: DataFrame,
    on: Keys,
    at: ColumnLike,
    lo: str,
    hi: str,
    within: tuple[DateLike, DateLike] | None = None,
    bucket_days: int | None = None,
) -> DataFrame:
    """Equi-join restricted to the validity interval ``lo..hi`` that holds on the row's date.

    ``within`` states the range all the row dates lie in. Intervals that do not touch it are
    then left out by the scan, before anything is exchanged. A row dated outside it stops the job.

    ``bucket_days`` is for keys with many rows on both sides whose dates are spread: the join
    also matches on date buckets of that width, so a row meets only the intervals near its
    date. An interval is repeated once per bucket it shares with ``within``, which bounds it.
    """
    right = _renamed(other, on)
    columns = _result(df, right, on)
    condition = _condition(on) & valid_on("_at", lo, hi)
    left = df.select("*", _col(at).alias("_at"))
    if within is not None:
        first, last = as_date(within[0]), as_date(within[1])
        right = right.where((F.col(hi) >= first) & (F.col(lo) <= last))
        # a column of its own, so that it is tested on the rows given and not pushed below their filters
        outside = F.raise_error(F.lit("a row is dated outside the stated range"))
        left = left.withColumn("_inside", F.when(~F.col("_at").between(first, last), outside).otherwise(F.lit(0)))
    if bucket_days is not None:
        if within is None:
            raise ValueError("bucket_days needs within")

        def bucket(date: Column) -> Column:
            return F.floor(F.unix_date(date) / F.lit(bucket_days))

        span = F.sequence(bucket(F.greatest(lo, first)), bucket(F.least(hi, last)))
        right = right.where(F.col(lo) <= F.col(hi)).select("*", F.explode(span).alias("_rb"))
        left = left.select("*", bucket(F.col("_at")).alias("_b"))
        condition = condition & (F.col("_b") == F.col("_rb"))
    joined = left.join(right, condition, "inner")
    if within is None:
        return joined.select(*columns)
    return joined.select(F.when(F.col("_inside") == 0, F.col(columns[0])).alias(columns[0]), *columns[1:])


def lookup_one(df: DataFrame, other: DataFrame, on: Keys, column: ColumnLike, name: str, hot: bool = False) -> DataFrame:
    """Add a scalar looked up by key, null when there is none.

    A row that meets more than one partner stops the job, as a scalar subquery does.
    """
    table = other.groupBy(*_right_keys(other, on)).agg(
        F.first(_col(column)).alias("_value"), F.count(F.lit(1)).alias("_n")
    )
    # the message is the value of a null-typed expression, so the result keeps the column's type
    stop = F.raise_error(F.lit(f"more than one row for {name}"))
    joined = _left_grouped(df, table, on, hot)
    return joined.select(*df.columns, F.when(F.col("_n") > 1, stop).otherwise(F.col("_value")).alias(name))


def lookup_as_of(
    df: DataFrame, other: DataFrame, on: Keys, column: ColumnLike, name: str, effdt: str, asof: DateLike
) -> DataFrame:
    """Scalar lookup in the rows in force on a date."""
    keys = [right for _, right in _pairs(on)]
    return lookup_one(df, latest_as_of(other, keys, effdt, asof), on, column, name)


def restrict_dim(dim: DataFrame, counted: DataFrame, on: Keys, columns: Sequence[str]) -> DataFrame:
    """Distinct dimension rows whose key occurs among the counted ones."""
    return semi(dim, counted, on).select(*columns).distinct()


def address_roles(
    df: DataFrame, current: DataFrame, key: str, columns: Sequence[str], home_type: str = "HOME", work_type: str = "HOME"
) -> DataFrame:
    """Join current addresses twice, as home and as work address.

    The feed asks for the home type in both roles, so home rows of one date multiply; pass
    another ``work_type`` to use a work address.
    """
    home = current.where(F.col("address_type") == home_type).select(F.col("emplid").alias("_h"), *columns)
    work = current.where(F.col("address_type") == work_type).select(
        F.col("emplid").alias("_w"), F.col("postal").alias("work_postal")
    )
    joined = df.join(home, F.col(key) == F.col("_h"), "inner")
    return joined.join(work, F.col(key) == F.col("_w"), "inner").drop("_h", "_w")
