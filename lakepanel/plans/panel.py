"""State x month panel: two unrelated fact sets joined at a shared grain.

Loans and complaints share no key.  Each side is aggregated to one row per
(state, month) first -- partial aggregation map-side, so even a state holding
a third of all rows is reduced before the shuffle -- and only those small
aggregates are joined.  Their size is bounded by states x months, not by the
raw data, and AQE broadcasts the smaller one at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import LENDING_FAMILIES, PANEL_MIN_RESOLVED
from ..functions import derive
from ..functions import metrics as M
from ..operators.joins import join_on_grain

GRAIN = ["state", "issue_month"]


def loan_segments(silver_loans: DataFrame, state_col: str = "addr_state") -> DataFrame:
    """Loans, defaults and resolved loans per state and issue month.

    ``default_rate`` is a fraction over resolved loans, null when none is
    resolved.  A null state stays as its own group (it cannot join later).
    """
    seg = (
        silver_loans.where(F.col("issue_date").isNotNull())
        .groupBy(F.col(state_col).alias("state"), derive.month_key("issue_date").alias("issue_month"))
        .agg(
            F.count(F.lit(1)).alias("loans"),
            F.sum("is_default").cast("long").alias("bad_loans"),
            F.sum("is_resolved").cast("long").alias("resolved_loans"),
        )
    )
    return seg.withColumn(
        "default_rate", M.null_safe_rate(F.col("bad_loans"), F.col("resolved_loans"), scale=1, digits=None)
    )


def complaint_segments(silver_complaints: DataFrame, families: Sequence[str] = LENDING_FAMILIES) -> DataFrame:
    """Complaints per state and month for the product families that overlap lending."""
    return (
        silver_complaints.where(F.col("product_family").isin(list(families)))
        .groupBy(F.col("state"), F.col("year_month").alias("issue_month"))
        .agg(F.count(F.lit(1)).alias("complaints"))
    )


def state_month_panel(
    loan_seg: DataFrame, complaint_seg: DataFrame, min_resolved: int = PANEL_MIN_RESOLVED
) -> DataFrame:
    """Cells present on both sides with enough resolved loans, plus complaint pressure."""
    joined = join_on_grain(loan_seg, complaint_seg, GRAIN, "inner")
    return joined.withColumn(
        "complaints_per_1k_loans", M.per_thousand(F.col("complaints"), F.col("loans"))
    ).where(F.col("resolved_loans") >= min_resolved)


def state_totals(panel: DataFrame) -> DataFrame:
    """Per state: ratio of summed counts (not a mean of cell rates), unordered."""
    return panel.groupBy("state").agg(
        M.null_safe_rate(F.sum("bad_loans"), F.sum("resolved_loans"), scale=1, digits=None).alias("default_rate"),
        M.per_thousand(F.sum("complaints"), F.sum("loans")).alias("complaints_per_1k_loans"),
    )


def state_rollup(panel: DataFrame) -> DataFrame:
    """The state roll-up as a report: highest default rate first."""
    return state_totals(panel).orderBy(F.col("default_rate").desc_nulls_last(), F.col("state"))


def panel_correlation(panel: DataFrame, rollup: DataFrame, digits: int = 6) -> DataFrame:
    """Pearson r of complaint pressure vs default rate, at cell and at state level.

    Two rows (``level`` = cell / state), each with the number of units.
    """
    def one(df: DataFrame, level: str) -> DataFrame:
        return df.agg(
            F.lit(level).alias("level"),
            F.count(F.lit(1)).alias("units"),
            F.round(M.safe_corr("complaints_per_1k_loans", "default_rate"), digits).alias("r"),
        )

    return one(panel, "cell").unionByName(one(rollup, "state"))
