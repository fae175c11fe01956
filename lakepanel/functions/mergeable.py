"""Mart metrics as sums that can be stored, added up and finished later.

A ``Metric`` has *parts*, aggregates that add up over disjoint sets of rows
(counts and exact decimal sums), and a *finish* that turns summed parts into
the shown number.  Finishing the parts of all rows at once, or the sum of
stored parts, gives the same value: decimal sums do not depend on order.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import metrics as M
from .parse import ColumnOrName


@dataclass(frozen=True)
class Metric:
    name: str
    parts: Mapping[str, Column]
    finish: Callable[[Mapping[str, Column]], Column]

    def whole(self) -> Column:
        """The metric as one aggregate over rows."""
        return self.finish(self.parts).alias(self.name)

    def partial(self) -> list[Column]:
        return [part.alias(f"{self.name}__{k}") for k, part in self.parts.items()]

    def merged(self, stored: DataFrame) -> Column:
        """The metric as one aggregate over stored partial rows."""
        types = dict(stored.dtypes)
        cells = {k: f"{self.name}__{k}" for k in self.parts}
        return self.finish({k: F.sum(c).cast(types[c]) for k, c in cells.items()}).alias(self.name)


def row_count(name: str) -> Metric:
    return Metric(name, {"n": F.count(F.lit(1))}, lambda p: F.coalesce(p["n"], F.lit(0)))


def flag_sum(name: str, flag: str) -> Metric:
    return Metric(name, {"n": F.sum(flag)}, lambda p: p["n"].cast("long"))


def scaled_sum(name: str, col: ColumnOrName, divisor: int, digits: int) -> Metric:
    divided = F.lit(divisor).cast("decimal(20,0)")
    return Metric(name, {"s": M.dsum(col)}, lambda p: M.round_ratio(p["s"], divided, digits))


def exact_avg(name: str, col: ColumnOrName, digits: int, dtype: str = M.RATE) -> Metric:
    d = M.dec(col, dtype)
    return Metric(name, {"s": F.sum(d), "n": F.count(d)}, lambda p: M.round_ratio(p["s"], p["n"].cast("decimal(20,0)"), digits))


def weighted_avg(name: str, value: ColumnOrName, weight: ColumnOrName, digits: int = 2) -> Metric:
    parts = {"s": F.sum(M.dec(weight, "decimal(18,2)") * M.dec(value, "decimal(12,4)")), "w": M.dsum(weight)}
    return Metric(name, parts, lambda p: M.round_ratio(p["s"], F.when(p["w"] > 0, p["w"]), digits))


def ratio_of_sums_pct(name: str, num: ColumnOrName, den: ColumnOrName, digits: int = 2) -> Metric:
    hundred = F.lit(100).cast("decimal(3,0)")
    parts = {"n": M.dsum(num), "d": M.dsum(den)}
    return Metric(name, parts, lambda p: M.round_ratio(hundred * p["n"], F.when(p["d"] > 0, p["d"]), digits))


def default_rate(name: str, scale: int = 100, digits: int | None = 2) -> Metric:
    parts = {"d": F.sum("is_default"), "r": F.sum("is_resolved")}
    return Metric(name, parts, lambda p: M.null_safe_rate(p["d"], p["r"], scale, digits))


@dataclass(frozen=True)
class Mart:
    """One grouped (or global) aggregate of mergeable metrics; ``order`` is the report order."""

    metrics: Sequence[Metric]
    group: Sequence[Column] = ()
    where: Column | None = None
    order: Sequence[Column] = field(default=())

    def _kept(self, rows: DataFrame) -> DataFrame:
        return rows if self.where is None else rows.where(self.where)

    def whole(self, rows: DataFrame, ordered: bool = True) -> DataFrame:
        out = self._kept(rows).groupBy(*self.group).agg(*[m.whole() for m in self.metrics])
        return out.orderBy(*self.order) if self.order and ordered else out

    def partial(self, rows: DataFrame, *by: str) -> DataFrame:
        """Partial rows per ``by`` columns and grain."""
        return self._kept(rows).groupBy(*by, *self.group).agg(*[c for m in self.metrics for c in m.partial()])

    def merge(self, stored: DataFrame, ordered: bool = False) -> DataFrame:
        """The mart from partial rows of disjoint sets of rows."""
        parts = {f"{m.name}__{k}" for m in self.metrics for k in m.parts}
        grain = [c for c in stored.columns if c not in parts]
        out = stored.groupBy(*grain).agg(*[m.merged(stored) for m in self.metrics])
        return out.orderBy(*self.order) if self.order and ordered else out


def partials_of_one_pass(
    marts: Mapping[str, Mart], rows: DataFrame, by: Sequence[str], grain: Sequence[Column] | None, store: Callable[[DataFrame], DataFrame]
) -> dict[str, DataFrame]:
    """Every mart's ``partial(rows, *by)``, read off one common aggregate of the rows.

    ``rows`` are aggregated once by a grain that is finer than each mart's, and
    ``store`` keeps the result, from which the marts' parts are added up.  ``grain``
    names columns that tell every mart's groups and conditions as the rows' own
    columns of these names do; without it, these are taken from each row.
    """
    kept = {n: F.lit(True) if m.where is None else F.coalesce(m.where, F.lit(False)) for n, m in marts.items()}
    parts = [part.alias(f"{n}__{m.name}__{k}") for n, mart in marts.items() for m in mart.metrics for k, part in m.parts.items()]
    own = [F.struct(kept[n].alias("kept"), *[F.when(kept[n], g).alias(f"g{k}") for k, g in enumerate(m.group)]).alias(f"{n}__at")
           for n, m in marts.items()]
    common = store(rows.groupBy(*by, *(own if grain is None else grain)).agg(*parts))
    out = {}
    for n, m in marts.items():
        schema = m.partial(rows, *by).schema
        names = schema.names[len(by):len(by) + len(m.group)]
        cells = m.group if grain is not None else [F.col(f"{n}__at.g{k}").alias(c) for k, c in enumerate(names)]
        sums = [F.sum(f"{n}__{f.name}").cast(f.dataType).alias(f.name) for f in schema[len(by) + len(m.group):]]
        out[n] = common.where(kept[n] if grain is not None else F.col(f"{n}__at.kept")).groupBy(*by, *cells).agg(*sums)
    return out
