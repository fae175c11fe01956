"""Joins of aggregates on a shared grain; the strategy is left to Catalyst and AQE."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def join_on_grain(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join of two aggregates on a shared grain; null keys never match.

    Both sides are already one row per key, so their size is bounded by the
    number of grain cells, not by the raw data; AQE turns the join into a
    broadcast join at run time when a side is under the broadcast threshold.
    """
    return left.join(right, list(keys), how)
