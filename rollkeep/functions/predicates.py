"""Boolean column expressions with the null behaviour the feeds rely on.

Every function returns a Column, so Catalyst can push it into a scan or a join.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str
DateLike = Column | dt.date | str


def _col(column: ColumnLike) -> Column:
    return F.col(column) if isinstance(column, str) else column


def as_date(value: DateLike) -> Column:
    """A date argument given as Column, ``date`` or ISO text."""
    if isinstance(value, Column):
        return value
    if isinstance(value, dt.date):
        return F.lit(value)
    return F.lit(dt.date.fromisoformat(value))


def in_list(column: ColumnLike, values: Sequence) -> Column:
    return _col(column).isin(*values)


def not_in(column: ColumnLike, values: Sequence) -> Column:
    """Plain negative list: a null value is neither in nor out, so its row is lost."""
    return ~_col(column).isin(*values)


def not_in_or_null(column: ColumnLike, values: Sequence) -> Column:
    """Negative list that keeps rows whose value is unknown."""
    return not_in(column, values) | _col(column).isNull()


def like(column: ColumnLike, pattern: str, negate: bool = False, fold_case: bool = False) -> Column:
    subject = F.upper(_col(column)) if fold_case else _col(column)
    matched = subject.like(pattern)
    return ~matched if negate else matched


def city_ok(column: ColumnLike, patterns: Sequence[str], exact: Sequence[str]) -> Column:
    """True unless the city is one of the excluded ones; an unknown city passes."""
    subject = F.upper(_col(column))
    excluded = F.lit(False)
    for pattern in patterns:
        excluded = excluded | subject.like(pattern)
    for value in exact:
        excluded = excluded | (subject == value)
    return F.coalesce(~excluded, F.lit(True))


def cutoff(column: ColumnLike, asof: DateLike) -> Column:
    return _col(column) <= as_date(asof)


def trailing_days(column: ColumnLike, asof: DateLike, lo: int = 36, hi: int = 1) -> Column:
    """Between ``asof - lo`` and ``asof - hi`` days, both ends included."""
    anchor = as_date(asof)
    return _col(column).between(F.date_sub(anchor, lo), F.date_sub(anchor, hi))


def open_or_closed_in(end: ColumnLike, lo: DateLike, hi: DateLike, allowed: Column | None = None) -> Column:
    """Still open, or closed inside the window for an allowed reason."""
    closed = _col(end).between(as_date(lo), as_date(hi))
    if allowed is not None:
        closed = closed & allowed
    return _col(end).isNull() | closed


def term_after(column: ColumnLike, limit: DateLike) -> Column:
    """Not ended, or ended strictly after the limit."""
    return _col(column).isNull() | (_col(column) > as_date(limit))


def valid_on(at: ColumnLike, lo: ColumnLike, hi: ColumnLike) -> Column:
    return _col(at).between(_col(lo), _col(hi))
