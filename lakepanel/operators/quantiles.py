"""Exact quantiles of many columns by sketch-bracketed counting; nothing is sorted or shuffled whole.

Each (column, probability) pair keeps an open interval that holds its answer.
A round is two aggregates over the data, for all open pairs at once:

1. a mergeable quantile sketch (``percentile_approx``) of the values inside the
   interval gives two values on either side of the wanted rank;
2. exact counts below and at these two values tell which part holds the rank,
   or that one of them is the answer.

The sketch only proposes, the counts decide, so the result is exact whatever
the sketch's error; an interval loses all but about ``4 / accuracy`` of its
values a round, so a trillion rows take three or four rounds.  Memory is the
sketches': ``columns x probabilities x accuracy`` numbers a task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def numeric_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t.startswith(NUMERIC)]


@dataclass
class _Open:
    """One quantile: its rank among the ``n`` values inside (``low``, ``high``), or its value."""

    column: str
    probability: float
    rank: int
    n: int
    low: object = None
    high: object = None
    value: object = None
    tried: tuple = ()

    def inside(self) -> Column:
        x = F.col(f"`{self.column}`")
        cond = x.isNotNull()
        if self.low is not None:
            cond = cond & (x > F.lit(self.low))
        if self.high is not None:
            cond = cond & (x < F.lit(self.high))
        return cond

    def proposals(self, accuracy: int) -> Column:
        """The sketch's values a little before and a little behind the rank."""
        slack = min(ceil(2 * self.n / accuracy), self.n // 4)
        around = [max(0.0, (self.rank - slack) / self.n), min(1.0, (self.rank + slack) / self.n)]
        return F.percentile_approx(F.when(self.inside(), F.col(f"`{self.column}`")), around, accuracy)

    def counts(self) -> list[Column]:
        x = F.col(f"`{self.column}`")
        return [F.count_if(self.inside() & cond) for v in self.tried for cond in (x < F.lit(v), x <= F.lit(v))]

    def narrow(self, below_a: int, to_a: int, below_b: int, to_b: int) -> None:
        """Keep the part that holds the rank."""
        a, b = self.tried
        if self.rank <= below_a:
            self.high, self.n = a, below_a
        elif self.rank <= to_a:
            self.value = a
        elif self.rank <= below_b:
            self.low, self.high, self.n, self.rank = a, b, below_b - to_a, self.rank - to_a
        elif self.rank <= to_b:
            self.value = b
        else:
            self.low, self.n, self.rank = b, self.n - to_b, self.rank - to_b


def _values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns with NaN as null and one zero."""
    floats = {c for c, t in df.dtypes if t in ("double", "float")}
    cell = lambda c: F.col(f"`{c}`")
    return df.select(*[F.when(~F.isnan(cell(c)), cell(c) + F.lit(0.0)).alias(c) if c in floats else cell(c) for c in columns])


def find_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], accuracy: int = 10_000) -> list[_Open]:
    """The quantiles' values, found in a few aggregate jobs (see the module)."""
    data = _values(df, columns)
    sizes = data.agg(*[F.count(F.col(f"`{c}`")).alias(str(k)) for k, c in enumerate(columns)]).first()
    out = [
        _Open(c, p, max(1, ceil(p * sizes[k])), sizes[k]) for k, c in enumerate(columns) for p in probabilities if sizes[k]
    ]
    while still := [q for q in out if q.value is None]:
        tried = data.agg(*[q.proposals(accuracy).alias(str(k)) for k, q in enumerate(still)]).first()
        for k, q in enumerate(still):
            q.tried = tuple(tried[k])
        counted = data.agg(*[c.alias(f"{k}_{j}") for k, q in enumerate(still) for j, c in enumerate(q.counts())]).first()
        for k, q in enumerate(still):
            q.narrow(*counted[4 * k : 4 * k + 4])
    return out


def exact_quantiles(
    df: DataFrame, columns: Sequence[str] | None = None, probabilities: Sequence[float] = (0.25, 0.5, 0.75), accuracy: int = 10_000
) -> DataFrame:
    """``column_name, probability, value, rows, below, at_most``: one row per column and probability.

    ``value`` (as double) is the smallest value that at least
    ``ceil(probability x rows)`` values do not exceed (the discrete quantile);
    ``below`` and ``at_most`` are its exact ranks, counted by the returned plan.
    Nulls and NaN are left out; a column without values gives nulls.
    """
    columns = numeric_columns(df) if columns is None else list(columns)
    found = {(q.column, q.probability): q.value for q in find_quantiles(df, columns, probabilities, accuracy)}
    aggs, parts = [], []
    for c in columns:
        x = F.col(f"`{c}`")
        for p in probabilities:
            k, value = len(aggs) // 4, found.get((c, p))
            at = F.lit(value)
            aggs += [
                F.min(F.when(x >= at, x)).cast("double").alias(f"v{k}"),
                F.count(x).alias(f"n{k}"),
                F.count_if(x < at).alias(f"b{k}"),
                F.count_if(x <= at).alias(f"a{k}"),
            ]
            name = c.replace("\\", "\\\\").replace("'", "\\'")
            parts.append(f"'{name}', double({p!r}), v{k}, n{k}, b{k}, a{k}")
    wide = _values(df, columns).agg(*aggs)
    return wide.selectExpr(f"stack({len(parts)}, {', '.join(parts)}) AS (column_name, probability, value, rows, below, at_most)")
