"""Scalar parsers and derived fields on the edge values of FIXTURES B."""

import datetime as dt

from pyspark.sql import functions as F

from lakepanel.functions import derive, parse


def one_col(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {dtype}")
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_to_double_is_ansi_safe(spark):
    assert one_col(spark, ["13.5", " 13.5", "abc", "", None], parse.to_double) == [13.5, 13.5, None, None, None]


def test_to_int_accepts_decimal_text(spark):
    assert one_col(spark, ["13", "13.0", "13.7", "", "x", None], parse.to_int) == [13, 13, 13, None, None, None]


def test_percent(spark):
    assert one_col(spark, ["13.5%", " 13.5", "abc", "250%", None], parse.percent) == [13.5, 13.5, None, 250.0, None]


def test_first_int(spark):
    assert one_col(spark, [" 36 months", "60 months", "", "none", None], parse.first_int) == [36, 60, None, None, None]


def test_employment_years(spark):
    got = one_col(spark, ["10+ years", "< 1 year", "3 years", "1 year", "n/a", None], parse.employment_years)
    assert got == [10, 0, 3, 1, None, None]


def test_month_name_date(spark):
    got = one_col(spark, ["Dec-2015", "dec-2015", "2015-12", "", None], parse.month_name_date)
    assert got == [dt.date(2015, 12, 1), dt.date(2015, 12, 1), None, None, None]


def test_text_date(spark):
    got = one_col(spark, ["2015-12-03", "2015-12-03 10:11:12", "01/31/13", None], parse.text_date)
    assert got == [dt.date(2015, 12, 3), dt.date(2015, 12, 3), None, None]


def test_yes_flag_and_has_text(spark):
    assert one_col(spark, ["Yes", "No", None], parse.yes_flag) == [True, False, None]
    assert one_col(spark, ["a", "", None], parse.has_text) == [True, False, False]


def test_status_flags(spark):
    values = ["Fully Paid", "Charged Off", "Default", "Current",
              "Does not meet the credit policy. Status:Charged Off", None]
    assert one_col(spark, values, derive.is_resolved) == [1, 1, 1, 0, 1, 0]
    assert one_col(spark, values, derive.is_default) == [0, 1, 1, 0, 1, 0]


def test_charge_off_loss_null_and_overpaid(spark):
    df = spark.createDataFrame(
        [(1, 1000.0, 300.0, 50.0), (1, 1000.0, 300.0, None), (1, 1000.0, 1200.0, 0.0), (0, 1000.0, 0.0, 0.0)],
        "d int, f double, p double, r double",
    )
    got = [r[0] for r in df.select(derive.charge_off_loss("d", "f", "p", "r")).collect()]
    assert got == [650.0, 0.0, 0.0, 0.0]


def test_installment_to_income_guard(spark):
    df = spark.createDataFrame([(100.0, 12000.0), (100.0, 0.0), (100.0, None)], "i double, a double")
    got = [r[0] for r in df.select(derive.installment_to_income("i", "a")).collect()]
    assert got == [0.1, None, None]


def test_age_years(spark):
    df = spark.createDataFrame([(dt.date(2015, 12, 1), dt.date(2013, 9, 1))], "a date, b date")
    assert df.select(derive.age_years("a", "b")).first()[0] == 2.3
