"""Every registered query against its DuckDB SQL on the driver tables (sf0.01)."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from lakepanel import queries
from lakepanel.sources.tables import DRIVER_TABLES

SF = "/root/testdata/sf0.01"
# The library's own queries; optional ones have tests of their own.
QUERIES = {k: v for k, v in entry.queries().items() if k in queries.queries()}
SQL = {k: v for k, v in entry.oracle_sql().items() if k in QUERIES}


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return None
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(records, cols):
    out = [tuple(_norm(r[c]) for c in cols) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in DRIVER_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_is_registered_with_sql_or_rows_only():
    rows_only = set(QUERIES) - set(SQL)
    assert rows_only == {"csv_plain_fragments", "line_preview"}
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF)
    cols = sorted(sdf.columns)
    s = [r.asDict() for r in sdf.collect()]
    rel = con.execute(SQL[name])
    dcols = [d[0] for d in rel.description]
    d = [dict(zip(dcols, r)) for r in rel.fetchall()]
    assert sorted(dcols) == cols
    assert len(s) == len(d)
    assert _rows(s, cols) == _rows(d, cols)


@pytest.mark.parametrize("name", ["csv_plain_fragments", "line_preview"])
def test_rows_only_queries_run(spark, name):
    assert QUERIES[name](spark, SF).count() >= 0


def test_plain_csv_read_fragments_multiline_text(spark):
    good = QUERIES["csv_multiline_roundtrip"](spark, SF).count()
    broken = QUERIES["csv_plain_fragments"](spark, SF).count()
    assert broken > good


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == [
        "state", "issue_month", "loans", "bad_loans", "resolved_loans", "default_rate",
        "complaints", "complaints_per_1k_loans",
    ]
