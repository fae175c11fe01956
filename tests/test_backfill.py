"""The backfill ledger: gaps, resumed runs, floors."""

import os

import pytest
from lakepanel.operators.calendar import month_spine
from lakepanel.plans import backfill
from lakepanel.plans.backfill import MonthBackfill

SCHEMA = "id bigint, day date"


@pytest.fixture
def source(spark):
    """Ten months, 2001-03 without rows and 2001-05 with one."""
    rows = spark.sql("SELECT id, date_add(DATE'2001-01-01', CAST(id % 304 AS INT)) AS day FROM range(3040)")
    rows = rows.where("month(day) <> 3 AND (month(day) <> 5 OR id = 130)")
    return rows


def files(path):
    return {m: sorted(os.listdir(f"{path}/{m}")) for m in os.listdir(path) if m.startswith("dt=")}


def test_an_interrupted_backfill_does_not_redo_done_months(spark, tmp_dir, source, monkeypatch):
    work = MonthBackfill(spark, f"{tmp_dir}/months", SCHEMA, min_bytes=100, chunk_months=3)
    spine = month_spine(source, "day")
    real, calls = backfill.land_month_partitions, []

    def dying(*args):
        calls.append(1)
        real(*args)
        if len(calls) == 2:
            raise KeyboardInterrupt  # the chunk's files are there, its ledger rows are not

    monkeypatch.setattr(backfill, "land_month_partitions", dying)
    with pytest.raises(KeyboardInterrupt):
        work.run(source, "day", spine)
    assert work.gaps(spine) == ["2001-03", "2001-04", "2001-05", "2001-06", "2001-07", "2001-08", "2001-09", "2001-10"]
    before = files(work.path)
    missing = work.gaps(spine)
    assert work.run(source, "day", spine) == missing
    after = files(work.path)
    assert {m: after[m] for m in ("dt=2001-01", "dt=2001-02")} == {m: before[m] for m in ("dt=2001-01", "dt=2001-02")}
    got = {r["month"]: (r["row_count"], r["state"]) for r in work.ledger().collect()}
    want = {r[0]: r[1] for r in source.selectExpr("date_format(day, 'yyyy-MM') AS m").groupBy("m").count().collect()}
    assert {m: n for m, (n, _) in got.items()} == {**want, "2001-03": 0}
    assert [m for m, (_, s) in sorted(got.items()) if s == "short"] == ["2001-03", "2001-05"]
    landed = spark.read.schema(f"{SCHEMA}, dt string").json(work.path)
    assert landed.count() == source.count() and landed.select("id").distinct().count() == source.count()


def test_short_months_stay_gaps_until_they_are_whole(spark, tmp_dir, source):
    work = MonthBackfill(spark, f"{tmp_dir}/months", SCHEMA, min_rows=50, min_bytes=100)
    spine = month_spine(source, "day")
    work.run(source, "day", spine)
    assert work.gaps(spine) == ["2001-03", "2001-05"]
    more = source.unionByName(spark.sql("SELECT id, DATE'2001-05-09' AS day FROM range(5000, 5100)"))
    assert work.run(more, "day", spine) == ["2001-03", "2001-05"]
    assert work.gaps(spine) == ["2001-03"]
    assert {r["month"]: r["row_count"] for r in work.ledger().collect()}["2001-05"] == 101


def test_a_run_can_be_bounded(spark, tmp_dir, source):
    work = MonthBackfill(spark, f"{tmp_dir}/months", SCHEMA, min_bytes=100, chunk_months=2)
    spine = month_spine(source, "day")
    assert work.run(source, "day", spine, max_months=3) == ["2001-01", "2001-02", "2001-03"]
    assert work.ledger().count() == 3
    assert "2001-04" in work.run(source, "day", spine)
