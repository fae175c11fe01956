"""Panel edge cells: support threshold, one-sided months, null states, zero resolved."""

import pytest

from lakepanel.functions import metrics as M
from lakepanel.plans import panel

LOAN_SEG = "state string, issue_month string, loans long, bad_loans long, resolved_loans long"


@pytest.fixture
def segments(spark):
    loans = spark.createDataFrame([
        ("CA", "2015-12", 200, 10, 100),   # exactly at the threshold: kept
        ("NY", "2015-12", 150, 5, 99),     # one below: dropped at 100
        ("TX", "2016-01", 50, 0, 0),       # nothing resolved: rate is null
        (None, "2015-12", 300, 30, 200),   # null state on both sides: never joins
        ("CA", "2016-02", 120, 1, 110),    # month with no complaints
    ], LOAN_SEG)
    loans = loans.withColumn("default_rate", M.null_safe_rate(
        loans["bad_loans"], loans["resolved_loans"], scale=1, digits=None))
    complaints = spark.createDataFrame([
        ("CA", "2015-12", 30), ("NY", "2015-12", 5), ("TX", "2016-01", 3),
        (None, "2015-12", 7), ("CA", "2016-03", 4),   # month with no loans
    ], "state string, issue_month string, complaints long")
    return loans, complaints


def _cells(df):
    return {(r["state"], r["issue_month"]): r.asDict() for r in df.collect()}


def test_threshold_keeps_100_and_drops_99(segments):
    cells = _cells(panel.state_month_panel(*segments, min_resolved=100))
    assert list(cells) == [("CA", "2015-12")]
    c = cells[("CA", "2015-12")]
    assert c["default_rate"] == 0.1 and c["complaints_per_1k_loans"] == 150.0


def test_only_cells_on_both_sides_with_a_state_are_kept(segments):
    cells = _cells(panel.state_month_panel(*segments, min_resolved=0))
    assert sorted(cells) == [("CA", "2015-12"), ("NY", "2015-12"), ("TX", "2016-01")]
    assert cells[("TX", "2016-01")]["default_rate"] is None
    assert cells[("TX", "2016-01")]["complaints_per_1k_loans"] == 60.0


def test_rollup_is_a_ratio_of_summed_counts(segments):
    cells = panel.state_month_panel(*segments, min_resolved=0)
    rows = [r.asDict() for r in panel.state_rollup(cells).collect()]
    # Highest default rate first, a null rate last.
    assert [r["state"] for r in rows] == ["CA", "NY", "TX"]
    assert rows[1]["default_rate"] == pytest.approx(5 / 99)
    assert rows[2]["default_rate"] is None and rows[2]["complaints_per_1k_loans"] == 60.0


def test_correlation_has_one_row_per_level(segments):
    cells = panel.state_month_panel(*segments, min_resolved=0)
    rows = {r["level"]: r for r in panel.panel_correlation(cells, panel.state_totals(cells)).collect()}
    assert set(rows) == {"cell", "state"}
    # Pairs with a null rate drop out; two points give r = +-1.
    assert rows["cell"]["units"] == 3 and abs(rows["cell"]["r"]) == pytest.approx(1.0)
