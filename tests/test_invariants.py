"""Invariants across registered queries (sf0.01) and a dedup property test."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakepanel import queries as Q
from lakepanel.operators import dedup
from lakepanel.plans import medallion

from testdata_paths import SF01


def _keys(df, cols):
    return {tuple(r) for r in df.select(*cols).collect()}


def test_panel_cells_are_cells_of_both_segments(spark):
    grain = ["state", "issue_month"]
    cells = _keys(Q.panel_state_month(spark, SF01), grain)
    assert cells
    assert cells <= _keys(Q.segment_loans(spark, SF01), grain)
    assert cells <= _keys(Q.segment_complaints(spark, SF01), grain)


def test_a_default_is_always_resolved(spark):
    sl = Q.silver_loans(spark, SF01)
    assert sl.where(F.col("is_default") > F.col("is_resolved")).count() == 0
    assert sl.where(F.col("is_default").isNull() | F.col("is_resolved").isNull()).count() == 0


def test_kept_plus_dropped_is_input_across_queries(spark):
    rep = Q.rules_report(spark, SF01).first()
    assert rep["kept_rows"] + rep["dropped_rows"] == rep["input_rows"]
    assert rep["kept_rows"] == Q.silver_loans(spark, SF01).count()
    assert rep["dropped_rows"] == Q.rules_drop(spark, SF01).count()


def test_segments_account_for_every_dated_loan_and_complaint(spark):
    sl = Q.silver_loans(spark, SF01)
    seg = Q.segment_loans(spark, SF01).agg(F.sum("loans")).first()[0]
    assert seg == sl.where(F.col("issue_date").isNotNull()).count()
    fam = Q.classify_family(spark, SF01).agg(F.sum("complaints")).first()[0]
    assert fam == Q.silver_complaints(spark, SF01).count()


def test_silver_never_gains_rows_over_bronze(spark):
    rows = {r["layer"]: r["row_count"] for r in Q.reconcile(spark, SF01).collect()}
    assert 0 < rows["silver"] <= rows["bronze"]


def test_dedup_is_idempotent(spark):
    once = Q.dedup_latest(spark, SF01)
    twice = dedup.latest_per_key(once, ["l_orderkey", "l_linenumber"], ["-l_shipdate"])
    assert once.count() == twice.count() == once.select("l_orderkey", "l_linenumber").distinct().count()
    assert once.exceptAll(twice).count() == 0


ROWS = st.lists(
    st.tuples(
        st.one_of(st.none(), st.integers(0, 4)),   # key (null keys are dropped)
        st.one_of(st.none(), st.integers(0, 3)),   # ordering column, nulls last
        st.integers(0, 2),                         # tie-break column
    ),
    max_size=40,
)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ROWS, parts=st.integers(1, 5))
def test_dedup_matches_brute_force_for_any_input_and_partitioning(spark, rows, parts):
    df = spark.createDataFrame(rows, "k int, v int, w int").repartition(parts)
    got = sorted(tuple(r) for r in dedup.latest_per_key(df, ["k"], ["-v"]).collect())
    # Brute force: per non-null key, largest v (nulls last), then smallest w.
    best = {}
    for k, v, w in rows:
        if k is None:
            continue
        rank = (v is None, -(v or 0), w)
        if k not in best or rank < best[k][0]:
            best[k] = (rank, (k, v, w))
    assert got == sorted(b for _, b in best.values())


def test_rules_observed_on_the_write_equal_the_explicit_report(spark):
    observed = medallion.rule_counts(spark, SF01)
    rep = Q.rules_report(spark, SF01).first()
    assert observed["rows"] == rep["input_rows"]
    assert observed["failed_core_not_null"] == rep["hard_core_not_null"]
    assert observed["failed_positive_amount"] == rep["hard_positive_amount"]
    assert observed["failed_plausible_rate"] == rep["soft_plausible_rate"]
    assert observed["failed_plausible_dti"] == rep["soft_plausible_dti"]


def test_a_failed_layer_write_is_rebuilt_in_a_fresh_folder(spark):

    calls = []

    def write(path):
        calls.append(path)
        if len(calls) == 1:
            raise RuntimeError("job failed mid-write")
        spark.range(3).write.parquet(path)

    with pytest.raises(RuntimeError):
        medallion.stored(spark, "test-retry", "scratch/retry", write)
    path = medallion.stored(spark, "test-retry", "scratch/retry", write)
    assert calls[0] != calls[1] and path == calls[1]
    assert spark.read.parquet(path).count() == 3
    # Stored once: later callers reuse it.
    assert medallion.stored(spark, "test-retry", "scratch/retry", write) == path and len(calls) == 2


def test_stored_layers_live_under_the_configured_checkpoint_folder(spark):
    # The test session names spark.checkpoint.dir, as a cluster would: every
    # stored layer must be written below it, never in a folder of our own.
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir").rstrip("/")
    path = medallion.stored(spark, "test-where", "scratch/where", lambda p: spark.range(1).write.parquet(p))
    assert path.removeprefix("file:").startswith(configured.removeprefix("file:"))
    assert spark.sparkContext.getCheckpointDir().removeprefix("file:").startswith(configured.removeprefix("file:"))
