"""Scalar expressions whose results differ between databases unless spelled out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollkeep.functions.predicates import ColumnLike, DateLike, _col, as_date

# What the phone clean-up removes. Characters outside this list, such as
# "(" and ")", stay in the result.
DIGITS = "1234567890"
PHONE_DROPPED = "-abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ `~!!&@#$%^*_+-=|\\:,./}{|><\""

# Legal form codes of a company.
LEGAL_FORMS = {
    "01": "Individual",
    "02": "Partnership",
    "03": "Corporation",
    "04": "Association",
    "05": "Limited Partnership",
    "06": "Joint Venture",
    "07": "Common Ownership",
    "08": "Multiple Status",
    "09": "Joint Employer",
    "10": "Limited Liability Company",
    "11": "Trust or Estate",
    "12": "Executor or Trustee",
    "13": "Limited Liability Partnership",
    "14": "Government Entity",
    "99": "Other",
}
LEGAL_FORM_DEFAULT = "Corporation"


def digits(column: ColumnLike) -> Column:
    """Phone number without the listed punctuation and letters."""
    return F.translate(_col(column), DIGITS + PHONE_DROPPED, DIGITS)


def initial(column: ColumnLike, mode: str = "reference") -> Column:
    """First letter of a middle name, empty when there is none.

    ``mode="reference"`` keeps the feed's off-by-one: a one-character substring that
    starts before the text is empty. ``mode="intended"`` returns the letter.
    """
    text = _col(column)
    if mode == "reference":
        return F.coalesce(F.substring(text, 1, 0), F.lit(""))
    if mode == "intended":
        return F.coalesce(F.substring(text, 1, 1), F.lit(""))
    raise ValueError(f"unknown mode {mode!r}")


def gender(column: ColumnLike) -> Column:
    """Unknown and empty become ``U``."""
    return F.coalesce(F.nullif(_col(column), F.lit("")), F.lit("U"))


def blank_if_null(column: ColumnLike) -> Column:
    return F.coalesce(_col(column), F.lit(""))


def ein(column: ColumnLike) -> Column:
    """Nine digits behind a sign blank; a number too long for nine digits shows ``#``."""
    number = _col(column).cast("long")
    sign = F.when(number < 0, F.lit("-")).otherwise(F.lit(" "))
    text = F.abs(number).cast("string")
    shown = F.when(F.length(text) > 9, F.lit("#" * 9)).otherwise(F.lpad(text, 9, "0"))
    return F.when(number.isNotNull(), F.concat(sign, shown))


def legal_status(column: ColumnLike) -> Column:
    code = _col(column)
    chosen = None
    for key, label in LEGAL_FORMS.items():
        chosen = F.when(code == key, label) if chosen is None else chosen.when(code == key, label)
    return chosen.otherwise(LEGAL_FORM_DEFAULT)


def flag(condition: Column) -> Column:
    return F.when(condition, F.lit("Y")).otherwise(F.lit("N"))


def whole_number(column: ColumnLike) -> Column:
    """Decimal to whole number, halves away from zero, as an assignment would do."""
    return F.round(_col(column), 0).cast("long")


def us_date(column: ColumnLike) -> Column:
    return F.date_format(_col(column), "MM/dd/yyyy")


def compact_date(column: ColumnLike) -> Column:
    return F.date_format(_col(column), "yyyyMMdd")


def parse_compact_date(column: ColumnLike) -> Column:
    """``CCYYMMDD`` text to a date; text that is no date gives null."""
    return F.try_to_date(_col(column), "yyyyMMdd")


def element(column: ColumnLike, position: int) -> Column:
    """Segment element by number (1 = first after the tag); absent or empty gives null."""
    return F.nullif(F.try_element_at(_col(column), F.lit(position + 1)), F.lit(""))


def filing_status(term: ColumnLike, effective: DateLike, direction: str) -> Column:
    """``ADD`` or ``CANCEL``. ``direction`` is ``before``, ``after`` or ``never``."""
    return F.when(_cancelled(term, effective, direction), F.lit("CANCEL")).otherwise(F.lit("ADD"))


def cancel_reason(term: ColumnLike, effective: DateLike, direction: str) -> Column:
    return F.when(_cancelled(term, effective, direction), F.lit("Client's Request")).otherwise(F.lit(" "))


def _cancelled(term: ColumnLike, effective: DateLike, direction: str) -> Column:
    if direction == "before":
        return _col(term) < as_date(effective)
    if direction == "after":
        return _col(term) > as_date(effective)
    if direction == "never":
        return F.lit(False)
    raise ValueError(f"unknown direction {direction!r}")
