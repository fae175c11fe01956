"""Classifiers (regex families, bands) and aggregate metrics."""

import pytest
from pyspark.sql import functions as F

from lakepanel.functions import classify
from lakepanel.functions import metrics as M


def test_product_family_first_match_wins(spark):
    products = [
        "Payday loan, title loan, or personal loan", "Consumer Loan", "Installment loan",
        "Credit card or prepaid card", "Mortgage", "Debt collection",
        "Credit reporting, credit repair services, or other personal consumer reports",
        "Student loan", "Vehicle loan or lease", None, "CREDIT CARD and mortgage",
    ]
    df = spark.createDataFrame([(p,) for p in products], "p string")
    got = [r[0] for r in df.select(classify.product_family("p")).collect()]
    assert got == [
        "personal_loan", "personal_loan", "personal_loan", "credit_card", "mortgage",
        "debt_collection", "credit_reporting", "other", "other", "other", "credit_card",
    ]


def test_bands_edges_are_half_open(spark):
    df = spark.createDataFrame([(v,) for v in [659.9, 660.0, 699.9, 700.0, 740.0, 780.0]], "v double")
    got = [r[0] for r in df.select(classify.fico_band("v")).collect()]
    assert got == ["1: <660 (subprime)", "2: 660-699", "2: 660-699", "3: 700-739", "4: 740-779", "5: 780+"]
    df = spark.createDataFrame([(v,) for v in [-1.0, 0.0, 10.0, 20.0, 30.0, 40.0, 130.0]], "v double")
    got = [r[0] for r in df.select(classify.dti_band("v")).collect()]
    assert got == ["1: <10", "1: <10", "2: 10-20", "3: 20-30", "4: 30-40", "5: 40+", "5: 40+"]


def test_default_rate_over_resolved_only(spark):
    df = spark.createDataFrame([(1, 1), (0, 1), (0, 0), (0, 0)], "is_default int, is_resolved int")
    assert df.agg(M.default_rate()).first()[0] == 50.0
    none = spark.createDataFrame([(0, 0)], "is_default int, is_resolved int")
    assert none.agg(M.default_rate()).first()[0] is None


def test_weighted_avg_counts_null_values_in_denominator(spark):
    df = spark.createDataFrame([(10.0, 100.0), (None, 100.0)], "x double, w double")
    assert df.agg(M.weighted_avg("x", "w")).first()[0] == 5.0


def test_exact_sum_rounding_is_half_up(spark):
    df = spark.createDataFrame([(1.005,), (0.0,)], "x double")
    assert df.agg(M.scaled_sum("x", 1, 2)).first()[0] == 1.01
    assert df.agg(M.exact_avg("x", 3)).first()[0] == 0.503  # 0.5025 -> half up


def test_safe_corr_guards_zero_variance(spark):
    const = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "x double, y double")
    assert const.agg(M.safe_corr("x", "y")).first()[0] is None
    line = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.5), (None, 1.0)], "x double, y double")
    r = line.agg(M.safe_corr("x", "y")).first()[0]
    ref = line.dropna().agg(F.corr("x", "y")).first()[0]
    assert r == pytest.approx(ref, abs=1e-12)


def test_per_thousand(spark):
    df = spark.createDataFrame([(3, 600), (1, 0)], "c long, n long")
    assert [r[0] for r in df.select(M.per_thousand("c", "n")).collect()] == [5.0, None]
