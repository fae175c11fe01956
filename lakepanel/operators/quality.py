"""Data quality: hard rules (drop), soft rules (count only), floors, reports.

A rule is a SQL predicate over one row.  A rule whose result is null counts
as failed, for hard and soft rules alike.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def _passes(rule: str) -> Column:
    return F.coalesce(F.expr(rule), F.lit(False))


def passes_all(rules: Mapping[str, str]) -> Column:
    """True when a row passes every rule (a null rule result is a failure)."""
    cond = F.lit(True)
    for rule in rules.values():
        cond = cond & _passes(rule)
    return cond


def apply_hard_rules(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Keep only rows that pass every rule (null = fail)."""
    return df.filter(passes_all(rules)) if rules else df


def rejected_rows(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """The rows the hard rules drop, with one ``pass_<rule>`` flag per rule.

    The complement of ``apply_hard_rules`` over the same input (a quarantine
    table): every input row lands in exactly one of the two.
    """
    flags = {f"pass_{n}": _passes(rule) for n, rule in rules.items()}
    out = df.withColumns(flags)
    keep = None
    for name in flags:
        keep = F.col(name) if keep is None else keep & F.col(name)
    return out if keep is None else out.filter(~keep)


def observe_rules(
    df: DataFrame,
    rules: Mapping[str, str],
    name: str = "quality",
) -> tuple[DataFrame, Observation]:
    """Attach failure counters to ``df`` without an extra pass.

    The counts are filled in by whatever action runs ``df`` next (e.g. the
    silver write); read them with ``observation.get``.
    """
    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows")]
    metrics += [F.count_if(~_passes(rule)).alias(f"failed_{n}") for n, rule in rules.items()]
    return df.observe(obs, *metrics), obs


def rule_report(
    df: DataFrame,
    hard_rules: Mapping[str, str],
    soft_rules: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row: input rows, rows kept by the hard rules, and failures per rule."""
    soft_rules = soft_rules or {}
    keep = None
    for rule in hard_rules.values():
        p = _passes(rule)
        keep = p if keep is None else keep & p
    aggs = [F.count(F.lit(1)).alias("input_rows")]
    aggs.append(F.count_if(keep if keep is not None else F.lit(True)).alias("kept_rows"))
    aggs += [F.count_if(~_passes(r)).alias(f"hard_{n}") for n, r in hard_rules.items()]
    aggs += [F.count_if(~_passes(r)).alias(f"soft_{n}") for n, r in soft_rules.items()]
    out = df.agg(*aggs)
    return out.withColumn("dropped_rows", F.col("input_rows") - F.col("kept_rows"))


class RowFloorError(AssertionError):
    pass


def check_row_floor(observed_rows: int, floor: int, what: str = "rows") -> int:
    """Raise when a load produced no more than ``floor`` rows (a broken parse)."""
    if observed_rows <= floor:
        raise RowFloorError(f"{what}: {observed_rows:,} <= floor {floor:,}; parse likely broke")
    return observed_rows


def row_floor_report(df: DataFrame, floor: int) -> DataFrame:
    """One row: row count, the floor, and whether the count is above it."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        "row_count",
        F.lit(floor).cast("long").alias("row_floor"),
        (F.col("row_count") > floor).alias("above_floor"),
    )
