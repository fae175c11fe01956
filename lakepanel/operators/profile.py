"""Column profiles: null counts per column and summary statistics, long form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def schema_frame(spark: SparkSession, df: DataFrame) -> DataFrame:
    """``(column_name, type, position)`` rows of a frame's schema."""
    rows = [(name, dtype, i) for i, (name, dtype) in enumerate(df.dtypes)]
    return spark.createDataFrame(rows, "column_name string, type string, position int")


def schema_listing(df: DataFrame) -> DataFrame:
    """``(column_name, type, position, row_count)`` rows: one counted row, stacked over the schema."""
    names = [name.replace("\\", "\\\\").replace("'", "\\'") for name in df.columns]
    parts = ", ".join(f"'{n}', '{t}', {i}" for i, (n, (_, t)) in enumerate(zip(names, df.dtypes)))
    counted = df.agg(F.count(F.lit(1)).alias("row_count"))
    return counted.selectExpr(f"stack({len(names)}, {parts}) AS (column_name, type, position)", "row_count")


def presence_flags(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Replace every column not in ``keep`` by a 1-byte presence flag (1 = not null).

    A null profile needs only whether each value is present.  Reducing wide
    columns (long text) to flags *before* a join means the join's shuffle
    moves one byte per value instead of the value; Catalyst cannot do this on
    its own, because it prunes columns, not expressions, below a join.
    """
    return df.select(*[
        F.col(f"`{c}`") if c in keep else F.col(f"`{c}`").isNotNull().cast("byte").alias(c)
        for c in df.columns
    ])


def null_profile(
    df: DataFrame, flags: Sequence[str] = (), types: dict[str, str] | None = None
) -> DataFrame:
    """Per column: total rows, non-null and null counts, and the type.

    One aggregation pass over ``df`` (wide row of counters), then a ``stack``
    to long form; the type comes from the schema, not from data.  Columns in
    ``flags`` were reduced by ``presence_flags`` (a null flag, e.g. from the
    missing side of an outer join, counts as absent); ``types`` then gives the
    original column types.
    """
    cols = df.columns
    flagged = set(flags)
    aggs = [F.count(F.lit(1)).alias("__total")]
    aggs += [
        (F.count_if(F.col(f"`{c}`") == 1) if c in flagged else F.count(F.col(f"`{c}`"))).alias(f"__nn_{i}")
        for i, c in enumerate(cols)
    ]
    wide = df.agg(*aggs)
    types = {**dict(df.dtypes), **(types or {})}
    parts = []
    for i, c in enumerate(cols):
        name = c.replace("'", "\\'")
        parts.append(f"'{name}', '{types[c]}', {i}, `__nn_{i}`")
    stacked = wide.selectExpr(
        "__total", f"stack({len(cols)}, {', '.join(parts)}) as (column_name, type, position, non_null)"
    )
    return stacked.select(
        "column_name",
        "type",
        F.col("position").cast("int").alias("position"),
        F.col("__total").alias("total_rows"),
        F.col("non_null").cast("long").alias("non_null"),
        (F.col("__total") - F.col("non_null")).alias("nulls"),
    )


def normalize_signed_zero(df: DataFrame) -> DataFrame:
    """``-0.0`` -> ``0.0`` in float columns (Spark compares them as equal, so
    which of the two a min/max returns would otherwise be arbitrary)."""
    floats = {c for c, t in df.dtypes if t in ("double", "float")}
    return df.select(*[(F.col(f"`{c}`") + F.lit(0.0)).alias(c) if c in floats else F.col(f"`{c}`") for c in df.columns])


def column_summary(df: DataFrame, stats: Sequence[str] = ("count", "min", "max")) -> DataFrame:
    """``DataFrame.summary`` transposed to one row per (column, statistic)."""
    summary = normalize_signed_zero(df).summary(*stats)
    value_cols = [c for c in summary.columns if c != "summary"]
    long = summary.unpivot("summary", value_cols, "column_name", "value")
    return long.select(F.col("column_name"), F.col("summary").alias("statistic"), F.col("value"))


def column_moments(df: DataFrame, digits: int) -> DataFrame:
    """``column_name, mean, stddev`` (sample) of numeric columns, rounded; one pass."""
    aggs = []
    for c in df.columns:
        value = F.col(f"`{c}`").cast("double")
        aggs += [F.round(F.avg(value), digits).alias(f"{c}__mean"), F.round(F.stddev_samp(value), digits).alias(f"{c}__std")]
    parts = ", ".join(f"'{c}', `{c}__mean`, `{c}__std`" for c in df.columns)
    return df.agg(*aggs).selectExpr(f"stack({len(df.columns)}, {parts}) as (column_name, mean, stddev)")
