"""Effective-dated selection: which rows of a key are in force on a date.

Each function first reduces the table to one best date (and sequence) per key, which Spark
combines on the map side, and then keeps the rows that equal it through a left semi join.
The join keys include the date, so the two sides are exchanged on (key, date): a key that
holds a large part of the table is spread over its dates, and rows that tie on one date can
still be split by adaptive skew handling because both inputs sit directly on an exchange.
No window ever sees all rows of a key. Outer filters put on the result are pushed to the row
side only, which is what the rules need.

Ties stay: all rows that share the best date (and sequence) are returned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollkeep.functions.predicates import DateLike, as_date

_PACK = 1 << 33


def _order_code(df: DataFrame, effdt: str, seq: str | None) -> Column:
    """One comparable value for (date, sequence); an unknown sequence sorts lowest.

    Date plus int fits one long, which keeps the reduction a hash aggregate. Other types
    fall back to a struct.
    """
    if seq is None:
        return F.col(effdt)
    small = (T.IntegerType, T.ShortType, T.ByteType)
    if isinstance(df.schema[effdt].dataType, T.DateType) and isinstance(df.schema[seq].dataType, small):
        place = F.coalesce(F.col(seq).cast("long") + F.lit((1 << 31) + 1), F.lit(0).cast("long"))
        return F.unix_date(F.col(effdt)).cast("long") * F.lit(_PACK) + place
    return F.struct(F.col(effdt), F.col(seq))


def _keep_best(rows: DataFrame, best: DataFrame, keys: Sequence[str], code: Column) -> DataFrame:
    """Rows whose key and code equal the best one of the key. ``best`` has keys ``_k*`` and ``_best``."""
    on = code == F.col("_best")
    for i, key in enumerate(keys):
        on = on & (F.col(key) == F.col(f"_k{i}"))
    return rows.join(best, on, "left_semi")


def _key_columns(keys: Sequence[str]) -> list[Column]:
    return [F.col(key).alias(f"_k{i}") for i, key in enumerate(keys)]


def latest_as_of(
    df: DataFrame,
    keys: Sequence[str],
    effdt: str,
    cutoff: DateLike | None = None,
    seq: str | None = None,
    status: str | None = None,
    status_value: str | None = None,
    status_in_key: bool = False,
) -> DataFrame:
    """Rows with the latest date at or before ``cutoff`` per key, then the latest ``seq`` on it.

    Without a cutoff a future-dated row wins. ``status`` keeps rows with ``status_value``:
    by default after the selection, so a later row of another status hides an older one;
    with ``status_in_key`` among the keys, so it does not. Rows with a null key or date never
    qualify, and a row with a null sequence is dropped even where it is alone on the date.
    """
    keys = list(keys)
    if status is not None and status_in_key:
        keys.append(status)
    eligible = F.col(effdt).isNotNull()
    if cutoff is not None:
        eligible = eligible & (F.col(effdt) <= as_date(cutoff))
    if status is not None and status_in_key:
        eligible = eligible & (F.col(status) == status_value)
    rows = df.where(eligible)
    code = _order_code(df, effdt, seq)
    best = rows.groupBy(*_key_columns(keys)).agg(F.max(code).alias("_best"))
    kept = _keep_best(rows, best, keys, code)
    if seq is not None:
        kept = kept.where(F.col(seq).isNotNull())
    if status is not None and not status_in_key:
        kept = kept.where(F.col(status) == status_value)
    return kept


def conditional_as_of(df: DataFrame, keys: Sequence[str], effdt: str, seq: str, condition: Column) -> DataFrame:
    """Rows on the latest date that has any row meeting ``condition``, with the latest ``seq`` on it.

    The rows returned need not meet the condition themselves, only one of their date must.
    """
    keys = list(keys)
    rows = df.where(F.col(effdt).isNotNull())
    names = [f"_k{i}" for i in range(len(keys))]
    per_date = rows.groupBy(*_key_columns(keys), F.col(effdt)).agg(
        F.max(seq).alias(seq), F.bool_or(condition).alias("_met")
    )
    best = per_date.where("_met").groupBy(*names).agg(F.max(_order_code(df, effdt, seq)).alias("_best"))
    return _keep_best(rows, best, keys, _order_code(df, effdt, seq)).where(F.col(seq).isNotNull())
