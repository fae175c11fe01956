"""Parsers and classifiers against plain-Python models on random text.

Each example is a batch of strings evaluated in one Spark job.  The alphabet
is chosen so that Java's and Python's number grammars agree on it (ASCII
digits, '.', '%', '+', '<', blanks, and letters that cannot spell nan/inf).
"""

import datetime as dt
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakepanel.constants import FICO_BANDS, FICO_TOP_BAND, PRODUCT_FAMILY_DEFAULT, PRODUCT_FAMILY_RULES
from lakepanel.functions import classify, parse

INT_MAX = 2**31 - 1
TEXT = st.one_of(st.none(), st.text(alphabet="0123456789.% +<ab", max_size=8))
BATCH = st.lists(TEXT, min_size=1, max_size=40)
SETTINGS = settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _eval(spark, values, *cols):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    return [tuple(r) for r in df.select(*cols).collect()]


def _float(text):
    try:
        return float(text.strip())
    except ValueError:
        return None


def _first_int(text):
    m = re.search(r"[0-9]+", text)
    if not m:
        return None
    n = int(m.group(0))
    return n if n <= INT_MAX else None


def _employment(text):
    if "10+" in text:
        return 10
    if "< 1" in text:
        return 0
    return _first_int(text)


@SETTINGS
@given(values=BATCH)
def test_numbers_and_percents(spark, values):
    got = _eval(spark, values, parse.to_double("s"), parse.percent("s"))
    for v, (d, p) in zip(values, got):
        exp_d = None if v is None else _float(v)
        exp_p = None if v is None else _float(v.replace("%", ""))
        assert d == exp_d, (v, d, exp_d)
        assert p == exp_p, (v, p, exp_p)


@SETTINGS
@given(values=BATCH)
def test_digit_runs_and_employment_years(spark, values):
    got = _eval(spark, values, parse.first_int("s"), parse.employment_years("s"))
    for v, (fi, emp) in zip(values, got):
        assert fi == (None if v is None else _first_int(v)), (v, fi)
        assert emp == (None if v is None else _employment(v)), (v, emp)


PRODUCT_TEXT = st.one_of(st.none(), st.sampled_from([
    "Payday loan", "PERSONAL LOAN", "Credit card or prepaid card", "Mortgage", "Debt collection",
    "Credit reporting", "Student loan", "Vehicle loan or lease", "installment credit card",
    "mortgage debt collection", "", "other thing",
]))


def _family(text):
    if text is None:
        return PRODUCT_FAMILY_DEFAULT
    for label, pattern in PRODUCT_FAMILY_RULES:
        if re.search(pattern, text):
            return label
    return PRODUCT_FAMILY_DEFAULT


def _fico(value):
    if value is None:
        return FICO_TOP_BAND
    for edge, label in FICO_BANDS:
        if value < edge:
            return label
    return FICO_TOP_BAND


@SETTINGS
@given(products=st.lists(PRODUCT_TEXT, min_size=1, max_size=30),
       scores=st.lists(st.one_of(st.none(), st.floats(600, 850, allow_nan=False)), min_size=1, max_size=30))
def test_ordered_classifiers(spark, products, scores):
    got = _eval(spark, products, classify.product_family("s"))
    assert [g[0] for g in got] == [_family(p) for p in products]
    df = spark.createDataFrame([(s,) for s in scores], "x double")
    bands = [r[0] for r in df.select(classify.fico_band(F.col("x"))).collect()]
    assert bands == [_fico(s) for s in scores]


MONTHS = ["Jan", "feb", "MAR", "Apr", "may", "Jun", "jUl", "Aug", "Sep", "Oct", "Nov", "Dec", "Dex", "Sept"]
MONTH_TEXT = st.one_of(
    st.none(),
    st.builds(lambda m, y, pre, post: f"{pre}{m}-{y}{post}",
              st.sampled_from(MONTHS), st.integers(1900, 2099),
              st.sampled_from(["", "", "", " "]), st.sampled_from(["", "", "", " "])),
    st.builds(lambda y, m: f"{y}-{m:02d}", st.integers(1990, 2030), st.integers(1, 12)),  # ISO month: not this format
)


def _month_name_date(text):
    if text is None:
        return None
    try:
        parsed = dt.datetime.strptime(text, "%b-%Y")  # %b is case-insensitive
    except ValueError:
        return None
    return parsed.date()


@SETTINGS
@given(values=st.lists(MONTH_TEXT, min_size=1, max_size=40))
def test_month_name_dates(spark, values):
    got = [g[0] for g in _eval(spark, values, parse.month_name_date("s"))]
    assert got == [_month_name_date(v) for v in values], list(zip(values, got))
