"""Plan shape of every registered query, and hot keys.

The small fixtures prove correctness; these tests pin the properties that
matter at scale: no pairwise joins, no Python in the plan, column pruning
and filter pushdown at the stored-silver scans, map-side reduction before
every shuffle of a hot key.
"""

import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lakepanel import queries as Q
from lakepanel.operators import dedup
from lakepanel.plans import driver_views, loans as loan_plans, panel

from testdata_paths import SF01

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "CollectLimit")
# The one query whose limit is the feature and has no ordering (first lines).
LIMIT_IS_THE_FEATURE = {"line_preview"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _read_schemas(plan: str) -> list[int]:
    """Column counts of every Parquet scan in the plan."""
    counts = []
    for line in plan.splitlines():
        if "FileScan parquet" in line:
            m = re.search(r"ReadSchema: struct<(.*)>", line)
            counts.append(len(m.group(1).split(",")) if m and m.group(1) else 0)
    return counts


@pytest.mark.parametrize("name", sorted(Q.queries()))
def test_plan_has_no_pairwise_join_or_python(spark, name):
    plan = _plan(Q.queries()[name](spark, SF01))
    for node in FORBIDDEN:
        if node == "CollectLimit" and name in LIMIT_IS_THE_FEATURE:
            continue
        assert node not in plan, f"{name}: {node}"


@pytest.mark.parametrize("name", [n for n in sorted(Q.queries()) if n.startswith(("mart_", "segment_", "panel_"))])
def test_gold_reads_few_silver_columns(spark, name):
    plan = _plan(Q.queries()[name](spark, SF01))
    # Gold products read stored silver only, so every scan is a silver scan.
    widths = _read_schemas(plan)
    assert widths, name
    # Silver holds ~50 columns; a gold product reads its handful.
    assert max(widths) <= 10, (name, widths)


def test_complaint_segments_push_family_filter_to_scan(spark):
    plan = _plan(Q.segment_complaints(spark, SF01))
    assert "PushedFilters: [In(product_family" in plan


def test_silver_lineage_reduces_per_key_before_the_shuffle(spark):
    plan = _plan(loan_plans.deduped_loans(driver_views.loans_bronze(spark, SF01)))
    # Map side: at most one row per loan id leaves each task.
    assert re.search(r"WindowGroupLimit \[loan_id#\d+L?\].*Partial", plan), plan


@pytest.mark.parametrize("name", ["rules_report", "rules_drop"])
def test_rule_products_scan_stored_candidates_not_the_raw_lineage(spark, name):
    plan = _plan(Q.queries()[name](spark, SF01))
    assert "WindowGroupLimit" not in plan and "Exchange hashpartitioning" not in plan, plan
    assert max(_read_schemas(plan)) <= 10


def test_null_profile_join_never_shuffles_document_text(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # the shuffle join used at scale
    try:
        plan = _plan(Q.null_profile(spark, SF01))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan
    # Below the document-side exchange, text is already a one-byte flag.
    assert "cast(isnotnull(text#" in plan


def _hot(spark, n=30_000):
    # Key 0 holds a third of all rows; the rest are spread over 2,000 keys.
    pdf = pd.DataFrame({"id": range(n)})
    pdf["k"] = [0 if i % 3 == 0 else 1 + i % 2000 for i in pdf["id"]]
    pdf["v"] = (pdf["id"] * 7919) % 10007
    return pdf, spark.createDataFrame(pdf).repartition(8)


def test_dedup_with_a_hot_key_matches_brute_force(spark):
    pdf, df = _hot(spark)
    got = dedup.latest_per_key(df, ["k"], ["-v"]).toPandas().set_index("k").sort_index()
    # Brute force: largest v per key, then smallest id as the tie-break.
    exp = (pdf.sort_values(["k", "v", "id"], ascending=[True, False, True])
           .groupby("k").head(1).set_index("k").sort_index())
    assert len(got) == len(exp) == 2001
    assert (got["v"] == exp["v"]).all() and (got["id"] == exp["id"]).all()


def test_panel_with_a_hot_state_matches_brute_force(spark):
    n = 24_000
    rows = [
        ("HOT" if i % 3 == 0 else f"S{i % 7}", f"2015-{1 + i % 12:02d}", int(i % 5 == 0), int(i % 2 == 0))
        for i in range(n)
    ]
    loans = spark.createDataFrame(rows, "addr_state string, ym string, is_default int, is_resolved int")
    loans = loans.select("addr_state", F.to_date(F.concat("ym", F.lit("-01"))).alias("issue_date"),
                         "is_default", "is_resolved").repartition(8)
    seg = panel.loan_segments(loans).toPandas()
    pdf = pd.DataFrame(rows, columns=["state", "issue_month", "d", "r"])
    exp = pdf.groupby(["state", "issue_month"]).agg(loans=("d", "size"), bad_loans=("d", "sum"),
                                                    resolved_loans=("r", "sum")).reset_index()
    m = seg.merge(exp, on=["state", "issue_month"], suffixes=("", "_exp"))
    assert len(m) == len(exp) == len(seg)
    for c in ("loans", "bad_loans", "resolved_loans"):
        assert (m[c] == m[f"{c}_exp"]).all()
    assert seg.loc[seg.state == "HOT", "loans"].sum() == n // 3


def _hash_shuffle_records(df) -> list[int]:
    """Run ``df`` (collect runs its own plan) and read each hash exchange's
    ``shuffleRecordsWritten`` from AQE's final plan."""
    df.collect()
    final = df._jdf.queryExecution().executedPlan().executedPlan()
    seen, out = set(), []

    def walk(node):
        name = node.nodeName()
        if name.endswith("QueryStage"):  # a stage is a leaf holding its plan
            inner = node.plan()
            if name == "ShuffleQueryStage" and "hashpartitioning" in inner.toString().splitlines()[0]:
                if inner.id() not in seen:
                    seen.add(inner.id())
                    out.append(inner.metrics().apply("shuffleRecordsWritten").value())
            walk(inner)
        kids = node.children()
        for i in range(kids.size()):
            walk(kids.apply(i))

    walk(final)
    return out


def test_hot_key_crosses_the_dedup_shuffle_as_one_row_per_map_task(spark):
    n, hot, tasks = 30_000, 10_000, 8
    # Key 0 holds a third of all rows; every other key is unique.
    df = spark.range(n).select(
        F.when(F.col("id") < hot, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    ).repartition(tasks)
    records = _hash_shuffle_records(dedup.latest_per_key(df, ["k"], ["-v"]))
    assert len(records) == 1
    # Without the map-side limit all 30,000 rows would be shuffled.
    assert n - hot < records[0] <= n - hot + tasks


def test_hot_state_crosses_the_segment_shuffle_as_one_row_per_group_and_task(spark):
    tasks = 8
    rows = spark.range(24_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("S"), (F.col("id") % 7).cast("string")))
        .alias("addr_state"),
        F.make_date(F.lit(2015), (F.col("id") % 12 + 1).cast("int"), F.lit(1)).alias("issue_date"),
        (F.col("id") % 5 == 0).cast("int").alias("is_default"),
        (F.col("id") % 2 == 0).cast("int").alias("is_resolved"),
    ).repartition(tasks)
    groups = 8 * 12  # HOT + S0..S6, twelve months
    records = _hash_shuffle_records(panel.loan_segments(rows))
    assert records and records[0] <= groups * tasks


@pytest.mark.parametrize("name,verdict", [("silver_loans", "pass"), ("mart_grade", "pass"), ("rules_drop", "fail")])
def test_loan_silver_and_quarantine_are_pruned_partitions(spark, name, verdict):
    # Candidates are stored once, partitioned by the hard-rule verdict; silver
    # and quarantine are read by partition pruning, never rewritten.
    plan = _plan(Q.queries()[name](spark, SF01))
    assert re.search(rf"PartitionFilters: \[[^\]]*\(hard_rules#\d+ = {verdict}\)", plan), plan
