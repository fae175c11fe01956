"""ANSI-safe text parsers (column builders).

Under Spark 4's ANSI mode a plain ``cast`` or ``to_date`` raises on the first
bad value, so every parser here uses the ``try_`` form and yields null for
text it cannot read.  All builders return ``Column`` expressions: they run
inside whole-stage codegen, never in Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import NUMERIC_ID_PATTERN

ColumnOrName = Column | str


def _c(col: ColumnOrName) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_double(col: ColumnOrName) -> Column:
    """Text -> double; surrounding blanks allowed, anything else unreadable is null."""
    return _c(col).try_cast("double")


def to_long(col: ColumnOrName) -> Column:
    return _c(col).try_cast("long")


def to_int(col: ColumnOrName) -> Column:
    """Text -> int through double, so ``"13.0"`` reads as 13 (fraction truncated)."""
    return _c(col).try_cast("double").try_cast("int")


def percent(col: ColumnOrName) -> Column:
    """``"13.5%"`` -> 13.5 (the number stays in percent units)."""
    return F.translate(_c(col), "%", "").try_cast("double")


def first_int(col: ColumnOrName) -> Column:
    """First run of digits as int: ``" 36 months"`` -> 36; no digits -> null."""
    return F.nullif(F.regexp_extract(_c(col), r"(\d+)", 1), F.lit("")).try_cast("int")


def employment_years(col: ColumnOrName) -> Column:
    """``"10+ years"`` -> 10, ``"< 1 year"`` -> 0, ``"3 years"`` -> 3, ``"n/a"`` -> null."""
    c = _c(col)
    return (
        F.when(c.rlike(r"10\+"), F.lit(10))
        .when(c.rlike("< 1"), F.lit(0))
        .otherwise(first_int(c))
    )


def month_name_date(col: ColumnOrName, fmt: str = "MMM-yyyy") -> Column:
    """``"Dec-2015"`` -> 2015-12-01 (case-insensitive); other text -> null."""
    return F.try_to_date(_c(col), fmt)


def text_date(col: ColumnOrName) -> Column:
    """Timestamp-like text -> date (time part dropped); unreadable -> null."""
    return F.to_date(_c(col).try_cast("timestamp"))


def yes_flag(col: ColumnOrName, yes: str = "Yes") -> Column:
    """``"Yes"`` -> true, other text -> false, null stays null."""
    return _c(col) == F.lit(yes)


def has_text(col: ColumnOrName) -> Column:
    """True when the value is present and not empty."""
    c = _c(col)
    return c.isNotNull() & (F.length(c) > 0)


def is_numeric_id(col: ColumnOrName, pattern: str = NUMERIC_ID_PATTERN) -> Column:
    """True for an all-digit id (drops summary footers and CSV fragments)."""
    return _c(col).rlike(pattern)
