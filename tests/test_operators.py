"""Dedup, rules, profiles, calendar, union, projections."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakepanel.operators import aggregate, calendar, columns, dedup, profile, quality, union
from lakepanel.operators.columns import MissingColumnsError
from lakepanel.operators.quality import RowFloorError
from lakepanel.sources.tables import rows_frame


def test_dedup_keeps_latest_and_drops_null_keys(spark):
    df = spark.createDataFrame(
        [(1, 1, "a"), (1, 3, "b"), (1, 2, "c"), (2, 1, "d"), (None, 9, "e")], "k long, ts int, v string"
    )
    got = sorted(tuple(r) for r in dedup.latest_per_key(df, ["k"], ["-ts"]).collect())
    assert got == [(1, 3, "b"), (2, 1, "d")]


def test_dedup_tie_break_is_total_and_partition_independent(spark):
    rows = [(k % 7, 0, f"v{(k * 37) % 11}") for k in range(200)]
    df = spark.createDataFrame(rows, "k long, ts int, v string")
    a = sorted(tuple(r) for r in dedup.latest_per_key(df, ["k"], ["-ts"]).collect())
    b = sorted(tuple(r) for r in dedup.latest_per_key(df.repartition(13).orderBy(F.rand(7)), ["k"], ["-ts"]).collect())
    assert a == b
    # idempotent
    once = dedup.latest_per_key(df, ["k"], ["-ts"])
    assert sorted(tuple(r) for r in dedup.latest_per_key(once, ["k"], ["-ts"]).collect()) == a
    # ties on ts resolved by the smallest remaining value
    assert all(r[2] == min(v for kk, _, v in rows if kk == r[0]) for r in a)


def test_dedup_plan_limits_before_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id"))
    plan = dedup.latest_per_key(df, ["k"], ["-id"])._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_hard_rules_null_counts_as_failure(spark):
    df = spark.createDataFrame([(1.0, "A"), (0.0, "A"), (-5.0, "B"), (None, "C"), (3.0, None)], "amt double, g string")
    rules = {"core": "amt IS NOT NULL AND g IS NOT NULL", "positive": "amt > 0"}
    kept = quality.apply_hard_rules(df, rules)
    assert kept.count() == 1
    rep = quality.rule_report(df, rules, {"soft": "amt BETWEEN 0 AND 2"}).first().asDict()
    assert rep["input_rows"] == 5 and rep["kept_rows"] == 1 and rep["dropped_rows"] == 4
    assert rep["hard_core"] == 2 and rep["hard_positive"] == 3 and rep["soft_soft"] == 3


def test_rejected_rows_are_the_complement_of_kept_rows(spark):
    df = spark.createDataFrame([(1.0, "A"), (0.0, "A"), (-5.0, "B"), (None, "C"), (3.0, None)], "amt double, g string")
    rules = {"core": "amt IS NOT NULL AND g IS NOT NULL", "positive": "amt > 0"}
    rejected = quality.rejected_rows(df, rules)
    assert rejected.columns == ["amt", "g", "pass_core", "pass_positive"]
    got = {(r.amt, r.g): (r.pass_core, r.pass_positive) for r in rejected.collect()}
    # A null rule result is a failure (False), never null.
    assert got == {
        (0.0, "A"): (True, False),
        (-5.0, "B"): (True, False),
        (None, "C"): (False, False),
        (3.0, None): (False, True),
    }
    kept = quality.apply_hard_rules(df, rules)
    assert kept.count() + rejected.count() == df.count()


def test_observe_rules_counts_on_the_write_pass(spark, tmp_dir):
    df = spark.createDataFrame([(1.0,), (250.0,), (None,)], "rate double")
    out, obs = quality.observe_rules(df, {"plausible": "rate BETWEEN 0 AND 100"})
    out.write.mode("overwrite").parquet(tmp_dir + "/o")
    assert obs.get == {"rows": 3, "failed_plausible": 2}


def test_row_floor(spark):
    assert quality.check_row_floor(10, 5) == 10
    with pytest.raises(RowFloorError):
        quality.check_row_floor(5, 5)
    df = spark.range(10)
    assert quality.row_floor_report(df, 5).first().asDict() == {"row_count": 10, "row_floor": 5, "above_floor": True}


def test_required_columns_raise_before_any_job(spark):
    df = spark.createDataFrame([("1",)], "`Complaint ID` string")
    with pytest.raises(MissingColumnsError):
        columns.rename_columns(df, {"Complaint ID": "complaint_id", "State": "state"})
    assert columns.rename_columns(df, {"Complaint ID": "complaint_id"}).columns == ["complaint_id"]


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "a long, `b c` string")
    got = {r["column_name"]: (r["type"], r["total_rows"], r["non_null"], r["nulls"]) for r in profile.null_profile(df).collect()}
    assert got == {"a": ("bigint", 3, 2, 1), "b c": ("string", 3, 1, 2)}


def test_null_profile_over_presence_flags_equals_plain_profile(spark):
    left = spark.createDataFrame(
        [(1, "long text", None), (2, None, 7), (3, "x", 8), (None, "y", None)], "id long, body string, n int"
    )
    right = spark.createDataFrame([(1, "a"), (3, None), (9, "z")], "id long, tag string")
    plain = profile.null_profile(left.join(right, "id", "left"))
    flagged_cols = ["body", "n"]
    flagged = profile.null_profile(
        profile.presence_flags(left, keep=["id"]).join(right, "id", "left"),
        flags=flagged_cols, types=dict(left.dtypes),
    )
    assert sorted(plain.collect()) == sorted(flagged.collect())


def test_column_summary_long_form(spark):
    df = spark.createDataFrame([(1.0, "a"), (-0.0, "b"), (0.0, None)], "x double, s string")
    got = {(r[0], r[1]): r[2] for r in profile.column_summary(df).collect()}
    assert got[("x", "count")] == "3" and got[("x", "min")] == "0.0" and got[("s", "max")] == "b"


def test_month_spine_clamps_both_ends(spark):
    bounds = spark.createDataFrame([(dt.date(2011, 12, 1), dt.date(2012, 3, 15))], "start date, end date")
    got = [tuple(r) for r in calendar.month_spine_from_bounds(bounds).orderBy("month").collect()]
    assert got == [
        ("2011-12", dt.date(2011, 12, 1), dt.date(2011, 12, 31)),
        ("2012-01", dt.date(2012, 1, 1), dt.date(2012, 1, 31)),
        ("2012-02", dt.date(2012, 2, 1), dt.date(2012, 2, 29)),
        ("2012-03", dt.date(2012, 3, 1), dt.date(2012, 3, 15)),
    ]


def test_window_counts_zero_fill_and_gaps(spark):
    bounds = spark.createDataFrame([(dt.date(2012, 1, 5), dt.date(2012, 4, 2))], "start date, end date")
    spine = calendar.month_spine_from_bounds(bounds)
    recs = spark.createDataFrame([(dt.date(2012, 1, 9),), (dt.date(2012, 1, 20),), (dt.date(2012, 3, 1),)], "d date")
    counts = {r["month"]: r["n"] for r in calendar.window_counts(spine, recs, "d", "n").collect()}
    assert counts == {"2012-01": 2, "2012-02": 0, "2012-03": 1, "2012-04": 0}
    landed = recs.select(F.date_format("d", "yyyy-MM").alias("month"))
    assert sorted(r["month"] for r in calendar.coverage_gaps(spine, landed).collect()) == ["2012-02", "2012-04"]
    few = calendar.coverage_gaps(spine, landed, min_rows=2).collect()
    assert sorted(r["month"] for r in few) == ["2012-02", "2012-03", "2012-04"]


def test_window_counts_leave_out_records_beyond_the_last_window(spark):
    bounds = spark.createDataFrame([(dt.date(2012, 1, 5), dt.date(2012, 2, 10))], "start date, end date")
    spine = calendar.month_spine_from_bounds(bounds)
    days = [dt.date(2011, 12, 31), dt.date(2012, 1, 1), dt.date(2012, 2, 10), dt.date(2012, 2, 11)]
    recs = spark.createDataFrame([(d,) for d in days], "d date")
    got = {(r["window_start"], r["window_end"]): r["n"] for r in calendar.window_counts(spine, recs, "d", "n").collect()}
    assert got == {(dt.date(2012, 1, 1), dt.date(2012, 1, 31)): 1, (dt.date(2012, 2, 1), dt.date(2012, 2, 10)): 1}


def test_union_by_name_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x", "p")], "id long, v string, props string")
    b = spark.createDataFrame([("y", 2)], "v string, id long")
    got = sorted(tuple(r) for r in union.union_by_name(a, b).collect())
    assert got == [(1, "x", "p"), (2, "y", None)]


def test_schema_frame_and_rows_frame(spark):
    df = rows_frame(spark, [(1, "a", 2.5)], "id long, `Date received` string, amt double")
    got = [tuple(r) for r in profile.schema_frame(spark, df).orderBy("position").collect()]
    assert got == [("id", "bigint", 0), ("Date received", "string", 1), ("amt", "double", 2)]



def test_multi_count_is_one_pass(spark):
    df = spark.range(10)
    out = aggregate.multi_count(df, {"even": F.col("id") % 2 == 0, "big": F.col("id") > 6})
    assert out.first().asDict() == {"even": 5, "big": 3}
