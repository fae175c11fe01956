"""Union by column name across sources whose schemas differ."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Union on names; a column missing from one input is null in its rows."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
