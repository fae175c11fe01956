"""Derived risk and economics columns of the loan silver layer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import DEFAULT_STATUS_PATTERN, RESOLVED_STATUS_PATTERN
from .metrics import dec, round_ratio
from .parse import ColumnOrName, _c


def age_years(later: ColumnOrName, earlier: ColumnOrName, digits: int = 1) -> Column:
    """Years between two dates (fractional), ``round(months_between / 12, digits)``."""
    return F.round(F.months_between(_c(later), _c(earlier)) / 12, digits)


def installment_to_income(installment: ColumnOrName, annual_inc: ColumnOrName) -> Column:
    """``installment * 12 / annual_inc`` to 4 dp; null when income is not positive.

    Computed on exact decimals of the values as written (8 places) and rounded
    half-up once, so a ratio lying exactly on a rounding edge, such as
    15.20285, rounds as written instead of by its binary double.  The guard
    looks at the very value that is divided by.

    Wide decimals are slow, so they are used where they can matter: a quotient
    of doubles decides alone where it is further from a rounding edge than
    the eighth place of either side could move it.
    """
    income = dec(annual_inc, "decimal(24,8)")
    exact = round_ratio(dec(installment, "decimal(20,8)") * F.lit(12).cast("decimal(2,0)"), F.when(income > 0, income), 4)
    a, b = _c(installment).cast("double"), _c(annual_inc).cast("double")
    units = a * 12 / F.when(b > 0, b) * 10_000
    slack = units * (F.lit(1e-8) / F.when(a > 0, a) + F.lit(1e-8) / F.when(b > 0, b)) + 1e-6
    far = (a < 1e11) & (b < 1e15) & (units < 1e12) & (F.abs(units - F.floor(units) - 0.5) > slack)
    return F.when(far, F.floor(units + 0.5).cast("double") / 10_000).otherwise(exact)


def status_flag(status: ColumnOrName, pattern: str) -> Column:
    """1 when the lower-cased status contains the pattern; null status -> 0."""
    return F.when(F.lower(_c(status)).rlike(pattern), F.lit(1)).otherwise(F.lit(0))


def is_resolved(status: ColumnOrName, pattern: str = RESOLVED_STATUS_PATTERN) -> Column:
    return status_flag(status, pattern)


def is_default(status: ColumnOrName, pattern: str = DEFAULT_STATUS_PATTERN) -> Column:
    return status_flag(status, pattern)


def net_cash(received: ColumnOrName, funded: ColumnOrName) -> Column:
    return _c(received) - _c(funded)


def charge_off_loss(
    default_flag: ColumnOrName,
    funded: ColumnOrName,
    principal: ColumnOrName,
    recoveries: ColumnOrName,
) -> Column:
    """Unrecovered principal of a defaulted loan, floored at zero.

    ``greatest`` skips nulls, so a null term yields 0.0, as does a loan that
    repaid more than it was funded.
    """
    loss = F.greatest(_c(funded) - _c(principal) - _c(recoveries), F.lit(0.0))
    return F.when(_c(default_flag) == 1, loss).otherwise(F.lit(0.0))


def month_key(date_col: ColumnOrName) -> Column:
    """``yyyy-MM`` text key of a date."""
    return F.date_format(_c(date_col), "yyyy-MM")


def year_of_key(key: ColumnOrName) -> Column:
    """Year text from a ``yyyy-MM`` / ``yyyy-MM-dd`` key."""
    return F.substring(_c(key), 1, 4)


def month_start(date_col: ColumnOrName) -> Column:
    """First day of the month as a date."""
    return F.trunc(_c(date_col), "month")
