"""Ordered rule classifiers: regex families and numeric bands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import (
    DTI_BANDS,
    DTI_TOP_BAND,
    FICO_BANDS,
    FICO_TOP_BAND,
    PRODUCT_FAMILY_DEFAULT,
    PRODUCT_FAMILY_RULES,
)
from .parse import ColumnOrName, _c


def ordered_regex_class(
    col: ColumnOrName, rules: Sequence[tuple[str, str]], default: str
) -> Column:
    """First matching ``(label, regex)`` wins; no match or null -> ``default``."""
    c = _c(col)
    expr = None
    for label, pattern in rules:
        cond = c.rlike(pattern)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def product_family(col: ColumnOrName) -> Column:
    return ordered_regex_class(col, PRODUCT_FAMILY_RULES, PRODUCT_FAMILY_DEFAULT)


def bands(col: ColumnOrName, edges: Sequence[tuple[float, str]], top: str) -> Column:
    """Half-open bands: ``value < edge`` picks the first label; the rest is ``top``.

    A null value falls through to ``top``; callers filter nulls first.
    """
    c = _c(col)
    expr = None
    for edge, label in edges:
        cond = c < F.lit(edge)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(top) if expr is None else expr.otherwise(F.lit(top))


def fico_band(col: ColumnOrName = "fico_avg") -> Column:
    return bands(col, FICO_BANDS, FICO_TOP_BAND)


def dti_band(col: ColumnOrName = "dti") -> Column:
    return bands(col, DTI_BANDS, DTI_TOP_BAND)
