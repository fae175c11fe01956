"""Month calendars: spine with clamped ends, per-window counts, coverage gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.derive import month_key


def month_spine_from_bounds(bounds: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """One row per month between ``start`` and ``end`` (dates, inclusive).

    ``bounds`` holds one row per range.  Each month gives ``window_start`` (its
    first day) and ``window_end`` (its last day, clamped to ``end``).
    """
    first = F.trunc(F.col(start), "month")
    months = bounds.select(
        F.col(end).alias("__end"),
        F.explode(F.sequence(first, F.col(end), F.expr("interval 1 month"))).alias("month_start"),
    )
    return months.select(
        month_key("month_start").alias("month"),
        F.col("month_start").alias("window_start"),
        F.least(F.last_day("month_start"), F.col("__end")).alias("window_end"),
    )


def month_spine(df: DataFrame, date_col: str) -> DataFrame:
    """Spine over the date range present in ``df[date_col]``."""
    d = F.to_date(F.col(date_col))
    bounds = df.agg(F.min(d).alias("start"), F.max(d).alias("end"))
    return month_spine_from_bounds(bounds)


def window_counts(spine: DataFrame, df: DataFrame, date_col: str, name: str = "records") -> DataFrame:
    """Records dated within each spine window, both ends included; zero for empty windows.

    The records are pre-aggregated to one row per day (map-side partial
    aggregation) before the join, so the join sees days, not records.
    """
    day = F.to_date(F.col(date_col))
    per_day = df.groupBy(day.alias("__day")).agg(F.count(F.lit(1)).alias("__n")).withColumn("__month", month_key("__day"))
    joined = spine.join(
        per_day,
        (F.col("month") == F.col("__month")) & F.col("__day").between(F.col("window_start"), F.col("window_end")),
        "left",
    )
    return joined.groupBy("month", "window_start", "window_end").agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("long").alias(name))


def coverage_gaps(spine: DataFrame, landed_months: DataFrame, month_col: str = "month", min_rows: int = 1) -> DataFrame:
    """Spine months with fewer than ``min_rows`` rows landed (anti-join on the month key)."""
    landed = landed_months.groupBy(F.col(month_col).alias("month")).agg(F.count(F.lit(1)).alias("__n"))
    return spine.join(landed.where(F.col("__n") >= min_rows).select("month"), "month", "left_anti")
