"""Generic aggregates: frequency tables, counts per key, ranges, top-k, head."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def frequency(df: DataFrame, by: Sequence[Column | str], name: str = "count") -> DataFrame:
    """Row count per group (partial counts are combined map-side)."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(name))


def frequency_desc(df: DataFrame, by: Sequence[Column | str], name: str = "count") -> DataFrame:
    """Frequency table, largest first, ties by group key."""
    out = frequency(df, by, name)
    keys = [c for c in out.columns if c != name]
    return out.orderBy(F.col(name).desc(), *[F.col(k).asc_nulls_first() for k in keys])


def min_max(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    return df.agg(*aggs)


def top_k(df: DataFrame, k: int, order_by: Sequence[Column]) -> DataFrame:
    """First ``k`` rows under a total order (planned as TakeOrderedAndProject)."""
    return df.orderBy(*order_by).limit(k)


def head_rows(df: DataFrame, k: int, key: Sequence[str]) -> DataFrame:
    """A stable preview: the first ``k`` rows by ``key``."""
    return df.orderBy(*[F.col(c).asc() for c in key]).limit(k)


def multi_count(df: DataFrame, named_conditions: dict[str, Column]) -> DataFrame:
    """Several filtered counts in one pass (instead of one job per ``count()``)."""
    return df.agg(*[F.count_if(cond).alias(name) for name, cond in named_conditions.items()])
