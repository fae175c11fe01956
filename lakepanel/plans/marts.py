"""Risk marts over loan silver: eight grouped aggregates of mergeable metrics.

Each mart reads only the columns it needs (pruned at the Parquet scan), and
its filters are pushed to the scan where Parquet can evaluate them.  Grouped
aggregates combine partial results map-side, so a hot group (one grade or
state holding a third of all loans) is reduced before the shuffle.

A mart is computed whole from silver, or merged from stored partial rows
(``plans.incremental``); both finish the same sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import GRADE_PATTERN, LENDING_FAMILIES
from ..functions import classify, derive
from ..functions import mergeable as G
from ..functions import metrics as M

def loan_marts() -> dict[str, G.Mart]:
    """The loan marts by table name, and the loans' panel segments."""
    loans, funded = G.row_count("loans"), G.scaled_sum("funded_mn", "funded_amnt", 1_000_000, 1)
    rate, defaults = G.exact_avg("avg_int_rate_pct", "int_rate", 2), G.default_rate("default_rate_pct")

    def by_dimension(column: str, alias: str) -> G.Mart:
        return G.Mart(
            [loans, funded, rate, defaults],
            group=[F.col(column).alias(alias)],
            where=F.col(column).isNotNull(),
            order=[F.col("loans").desc(), F.col(alias)],
        )

    return {
        # One row of headline portfolio numbers.
        "gold_portfolio_kpis": G.Mart([
            G.row_count("total_loans"),
            G.scaled_sum("total_funded_bn", "funded_amnt", 1_000_000_000, 2),
            G.exact_avg("avg_loan_amnt", "loan_amnt", 0, M.MONEY),
            G.weighted_avg("wavg_int_rate_pct", "int_rate", "funded_amnt", 2),
            G.exact_avg("avg_fico", "fico_avg", 0),
            G.exact_avg("avg_dti", "dti", 1),
            defaults,
            G.scaled_sum("charge_off_loss_mn", "charge_off_loss", 1_000_000, 1),
            G.ratio_of_sums_pct("realized_return_pct", "net_cash", "funded_amnt"),
        ]),
        "gold_risk_by_grade": G.Mart(
            [
                loans, funded, rate,
                G.exact_avg("avg_fico", "fico_avg", 0),
                defaults,
                G.ratio_of_sums_pct("loss_rate_pct", "charge_off_loss", "funded_amnt"),
                G.ratio_of_sums_pct("realized_return_pct", "net_cash", "funded_amnt"),
            ],
            group=[F.col("grade")],
            where=F.col("grade").rlike(GRADE_PATTERN),
            order=[F.col("grade")],
        ),
        "gold_vintage": G.Mart(
            [loans, funded, rate, defaults],
            group=[F.year("issue_date").alias("vintage_year")],
            where=F.col("issue_date").isNotNull(),
            order=[F.col("vintage_year")],
        ),
        "gold_origination_trend": G.Mart(
            [loans, G.scaled_sum("funded_mn", "funded_amnt", 1_000_000, 2), rate],
            group=[F.trunc("issue_date", "month").alias("issue_month")],
            where=F.col("issue_date").isNotNull(),
            order=[F.col("issue_month")],
        ),
        "gold_geo_risk": by_dimension("addr_state", "state"),
        "gold_purpose_risk": by_dimension("purpose", "purpose"),
        "gold_fico_band_risk": G.Mart(
            [loans, rate, defaults],
            group=[classify.fico_band("fico_avg").alias("fico_band")],
            where=F.col("fico_avg").isNotNull(),
            order=[F.col("fico_band")],
        ),
        "gold_dti_band_risk": G.Mart(
            [loans, defaults],
            group=[classify.dti_band("dti").alias("dti_band")],
            where=F.col("dti").isNotNull() & (F.col("dti") >= 0),
            order=[F.col("dti_band")],
        ),
        "gold_loan_segments": G.Mart(
            [
                loans, G.flag_sum("bad_loans", "is_default"), G.flag_sum("resolved_loans", "is_resolved"),
                G.default_rate("default_rate", scale=1, digits=None),
            ],
            group=[F.col("addr_state").alias("state"), derive.month_key("issue_date").alias("issue_month")],
            where=F.col("issue_date").isNotNull(),
        ),
    }


def loan_passes() -> list[tuple[list[str], list[Column] | None]]:
    """The loan marts that share a pass over the rows, with the grain of that pass (``partials_of_one_pass``).

    A loan's state and month tell the first ones' groups.  The others' take few
    values each: grade, purpose and two bands.
    """
    month = F.trunc("issue_date", "month").alias("issue_date")
    return [
        (["gold_portfolio_kpis", "gold_vintage", "gold_origination_trend", "gold_geo_risk", "gold_loan_segments"], [F.col("addr_state"), month]),
        (["gold_risk_by_grade", "gold_purpose_risk", "gold_fico_band_risk", "gold_dti_band_risk"], None),
    ]


def complaint_marts() -> dict[str, G.Mart]:
    """The complaints' panel segments."""
    return {
        "gold_complaint_segments": G.Mart(
            [G.row_count("complaints")],
            group=[F.col("state"), F.col("year_month").alias("issue_month")],
            where=F.col("product_family").isin(list(LENDING_FAMILIES)),
        ),
    }


def _whole(name: str):
    def build(silver: DataFrame, ordered: bool = True) -> DataFrame:
        return loan_marts()[name].whole(silver, ordered)

    build.__name__ = name.removeprefix("gold_")
    return build


portfolio_kpis = _whole("gold_portfolio_kpis")
risk_by_grade = _whole("gold_risk_by_grade")
vintage = _whole("gold_vintage")
origination_trend = _whole("gold_origination_trend")
geo_risk = _whole("gold_geo_risk")
purpose_risk = _whole("gold_purpose_risk")
fico_band_risk = _whole("gold_fico_band_risk")
dti_band_risk = _whole("gold_dti_band_risk")

MARTS = {
    "gold_portfolio_kpis": portfolio_kpis,
    "gold_risk_by_grade": risk_by_grade,
    "gold_vintage": vintage,
    "gold_origination_trend": origination_trend,
    "gold_geo_risk": geo_risk,
    "gold_purpose_risk": purpose_risk,
    "gold_fico_band_risk": fico_band_risk,
    "gold_dti_band_risk": dti_band_risk,
}
