"""Aggregate column builders: rates, exact money sums, weighted means.

Money is summed as DECIMAL so a sum does not depend on task order, and it is
divided and rounded as DECIMAL so ``round`` sees the exact value (a double
like 1.005 is really 1.00499..., which rounds differently per engine).  The
result is cast to double at the very end.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .parse import ColumnOrName, _c

MONEY = "decimal(20,2)"
RATE = "decimal(20,4)"


def dec(col: ColumnOrName, dtype: str = MONEY) -> Column:
    """Exact decimal copy of a double column (null when it does not fit)."""
    return _c(col).try_cast(dtype)


def dsum(col: ColumnOrName, dtype: str = MONEY) -> Column:
    """Exact sum of a double money column."""
    return F.sum(dec(col, dtype))


def round_ratio(num: Column, den: Column, digits: int) -> Column:
    """``num / den`` rounded half-up to ``digits``, once, as double; null when ``den`` is 0 or null.

    Both sides are exact decimals.  The quotient is never materialised at an
    intermediate scale: whole units of the last digit come from the exact
    remainder, and the remainder alone decides the rounding.
    """
    den = F.when(den != 0, den)
    scaled = num * F.lit(10**digits).cast(f"decimal({digits + 1},0)")
    rest = scaled % den
    whole = ((scaled - rest) / den).cast("decimal(38,0)")
    up = F.when(F.abs(rest) * 2 >= F.abs(den), F.signum(num.cast("double")) * F.signum(den.cast("double")))
    units = whole + F.coalesce(up, F.lit(0.0)).cast("decimal(1,0)")
    return (units.cast("decimal(30,0)") / F.lit(10**digits).cast(f"decimal({digits + 1},0)")).cast("double")


def scaled_sum(col: ColumnOrName, divisor: int, digits: int, dtype: str = MONEY) -> Column:
    """``round(sum(col) / divisor, digits)``, e.g. funded amount in millions."""
    return round_ratio(dsum(col, dtype), F.lit(divisor).cast("decimal(20,0)"), digits)


def exact_avg(col: ColumnOrName, digits: int, dtype: str = RATE) -> Column:
    """``round(avg(col), digits)`` computed on decimals (nulls ignored)."""
    d = dec(col, dtype)
    return round_ratio(F.sum(d), F.count(d).cast("decimal(20,0)"), digits)


def null_safe_rate(num: Column, den: Column, scale: float | int = 100, digits: int | None = 2) -> Column:
    """``scale * num / den`` with the denominator null when it is not positive.

    ``scale=100`` gives percent, ``scale=1`` a fraction.  With ``digits``,
    counts are taken as whole numbers.
    """
    safe_den = F.when(den > 0, den)
    if digits is None:
        return F.lit(scale) * num / safe_den
    value = F.lit(scale).cast("decimal(10,0)") * num.cast("decimal(20,0)")
    return round_ratio(value, safe_den.cast("decimal(20,0)"), digits)


def default_rate(flag_default: str = "is_default", flag_resolved: str = "is_resolved",
                 scale: float | int = 100, digits: int | None = 2) -> Column:
    """Defaults over *resolved* loans only; null when nothing is resolved."""
    return null_safe_rate(F.sum(flag_default), F.sum(flag_resolved), scale, digits)


def ratio_of_sums_pct(num: ColumnOrName, den: ColumnOrName, digits: int = 2) -> Column:
    """``100 * sum(num) / sum(den)`` on exact money sums; null when sum(den) <= 0."""
    n = dsum(num)
    d = dsum(den)
    return round_ratio(F.lit(100).cast("decimal(3,0)") * n, F.when(d > 0, d), digits)


def weighted_avg(value: ColumnOrName, weight: ColumnOrName, digits: int = 2) -> Column:
    """``sum(w * x) / sum(w)``.  Rows whose ``x`` is null still count in ``sum(w)``."""
    num = F.sum(dec(weight, "decimal(18,2)") * dec(value, "decimal(12,4)"))
    den = dsum(weight)
    return round_ratio(num, F.when(den > 0, den), digits)


def count_unfit(col: ColumnOrName, dtype: str = MONEY) -> Column:
    """How many non-null values (NaN, or too large) an exact sum leaves out."""
    return F.count_if(_c(col).isNotNull() & dec(col, dtype).isNull())


def per_thousand(num: ColumnOrName, den: ColumnOrName) -> Column:
    """``num / den * 1000`` (null when ``den`` is not positive)."""
    d = _c(den)
    return F.when(d > 0, _c(num) / d * 1000)


def safe_corr(x: ColumnOrName, y: ColumnOrName) -> Column:
    """Pearson r of non-null pairs; null when a variance is 0 or nothing is paired.

    ``covar_pop / (stddev_pop * stddev_pop)`` over the same pairs, with our own
    guarded division: a constant column gives null instead of raising
    DIVIDE_BY_ZERO under ANSI mode (which ``F.corr`` does).
    """
    xc, yc = _c(x).cast("double"), _c(y).cast("double")
    both = xc.isNotNull() & yc.isNotNull()
    xs, ys = F.when(both, xc), F.when(both, yc)
    den = F.stddev_pop(xs) * F.stddev_pop(ys)
    return F.when(den > 0, F.covar_pop(xs, ys) / den)
