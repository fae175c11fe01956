"""Merging batches against rebuilds: rows, marts, rule log, accounts."""

import os
import random

import pytest
from lakepanel.constants import LOAN_HARD_RULES
from lakepanel.operators.dedup import latest_per_key
from lakepanel.plans import marts, panel
from lakepanel.plans.complaints import silver_complaints
from lakepanel.plans.driver_views import complaints_bronze, loans_bronze
from lakepanel.plans.incremental import incremental_complaints, incremental_loans
from lakepanel.plans.loans import deduped_loans, silver_loans
from lakepanel.sources import keyed_table, versions
from lakepanel.sources.keyed_table import KeyedTable
from pyspark.sql import functions as F
from testdata_paths import SF001


def rows(df, cols=None):
    cols = sorted(cols or df.columns)
    return sorted(map(repr, (tuple(r) for r in df.select(*[f"`{c}`" for c in cols]).collect())))


def batch(spark, rng, k, n, keys=40):
    data = [(rng.choice([None, 7, *range(keys)]), k, rng.randint(0, 3), rng.choice(["a", "b", None])) for _ in range(n)]
    return spark.createDataFrame(data, "id long, load int, x int, `odd name` string")


def test_three_batches_equal_one_rebuild(spark, tmp_dir):
    rng = random.Random(3)
    table = KeyedTable(spark, f"{tmp_dir}/t", ["id"], ["-load"], buckets=8)
    batches = [batch(spark, rng, k, 60) for k in range(3)]
    for b in batches:
        table.merge(b)
    whole = latest_per_key(batches[0].unionByName(batches[1]).unionByName(batches[2]), ["id"], ["-load"])
    assert rows(table.read()) == rows(whole)
    before = rows(table.read())
    table.merge(batches[1])  # a replay, out of order
    assert rows(table.read()) == before


def test_only_touched_buckets_are_rewritten(spark, tmp_dir):
    table = KeyedTable(spark, f"{tmp_dir}/t", ["id"], ["-load"], buckets=16)
    table.merge(spark.range(500).selectExpr("id", "0 AS load"))
    first = table.mapping()
    touched = table.merge(spark.createDataFrame([(3, 1), (3, 1), (None, 1)], "id long, load int"))
    second = table.mapping()
    assert len(touched) == 1 and len(first) == 16
    assert [b for b in second if second[b] != first[b]] == touched
    assert table.read().count() == 500 and table.read().where("load = 1").count() == 1
    wide = spark.createDataFrame([(9, 2, "new")], "id long, load int, more string")
    table.merge(wide)
    assert table.read().where("more IS NULL").count() == 499
    # Folders that the last two versions do not use are gone.
    held = {(b, v) for _, name in versions.markers(spark, table.folder) for b, v in table.mapping(name).items()}
    on_disk = {(int(b.split("=")[1]), v) for v in os.listdir(f"{table.folder}/data") for b in os.listdir(f"{table.folder}/data/{v}") if "=" in b}
    assert on_disk == held


def test_a_merge_that_dies_leaves_the_version_before(spark, tmp_dir, monkeypatch):
    table = KeyedTable(spark, f"{tmp_dir}/t", ["id"], ["-load"], buckets=4)
    table.merge(spark.range(20).selectExpr("id", "0 AS load"))

    def die(*args):
        raise KeyboardInterrupt

    monkeypatch.setattr(keyed_table, "point_to", die)
    with pytest.raises(KeyboardInterrupt):
        table.merge(spark.range(30).selectExpr("id", "1 AS load"))
    monkeypatch.undo()
    assert table.read().count() == 20
    table.merge(spark.range(30).selectExpr("id", "1 AS load"))
    assert table.read().where("load = 1").count() == 30


@pytest.fixture(scope="module")
def loan_loads(spark, tmp_path_factory):
    """Three stored loads of the loan view, with ids that come again changed."""
    folder = str(tmp_path_factory.mktemp("loads"))
    raw = loans_bronze(spark, SF001).drop("_source_file", "_ingested_at")
    n = F.col("id").try_cast("bigint")
    loads = [
        raw.where(n % 3 != 2),
        raw.where((n % 3 == 2) | (n % 5 == 0)).withColumn("loan_status", F.when(n % 5 == 0, "Charged Off").otherwise(F.col("loan_status"))),
        raw.where(n % 7 == 0).withColumns({"loan_amnt": F.when(n % 2 == 0, "0").otherwise(F.col("loan_amnt")), "id": F.when(n % 35 == 0, "x").otherwise(F.col("id"))}),
    ]
    out = []
    for k, load in enumerate(loads):
        stamped = load.withColumns({"_source_file": F.lit(f"load_{k}"), "_ingested_at": F.lit(f"2024-01-0{k + 1}").cast("timestamp")})
        stamped.write.parquet(f"{folder}/{k}")
        out.append(spark.read.parquet(f"{folder}/{k}"))
    return out


def test_loans_and_marts_equal_their_recompute(spark, tmp_dir, loan_loads):
    layer = incremental_loans(spark, f"{tmp_dir}/loans", buckets=8)
    accounts = [layer.load(load, f"b{k}") for k, load in enumerate(loan_loads)]
    bronze = loan_loads[0].unionByName(loan_loads[1]).unionByName(loan_loads[2])
    silver = silver_loans(bronze)
    assert rows(layer.silver()) == rows(silver)
    assert rows(layer.candidates()) == rows(deduped_loans(bronze))
    assert layer.quarantine().count() > 0
    for name, build in marts.MARTS.items():
        assert rows(layer.mart(name)) == rows(build(silver)), name
        assert layer.mart(name).schema.simpleString() == build(silver).schema.simpleString()
    assert rows(layer.mart("gold_loan_segments")) == rows(panel.loan_segments(silver))
    before = rows(layer.mart("gold_geo_risk")), rows(layer.rule_log()), rows(layer.row_account())
    assert layer.load(loan_loads[1], "b1") == accounts[1]  # a replay is counted once
    assert (rows(layer.mart("gold_geo_risk")), rows(layer.rule_log()), rows(layer.row_account())) == before
    assert [r["batch"] for r in layer.rule_log().select("batch").distinct().orderBy("batch").collect()] == ["b0", "b1", "b2"]
    account = {r["batch"]: r for r in layer.row_account().collect()}
    assert all(r["balanced"] for r in account.values())
    assert account["b2"]["null_keys"] > 0 and account["b2"]["rejected"] > 0


def test_complaint_segments_equal_their_recompute(spark, tmp_dir):
    complaints_bronze(spark, SF001).write.parquet(f"{tmp_dir}/bronze")
    bronze = spark.read.parquet(f"{tmp_dir}/bronze")
    layer = incremental_complaints(spark, f"{tmp_dir}/complaints", buckets=4)
    parts = [bronze.where("`Complaint ID` IS NULL OR crc32(`Complaint ID`) % 2 = 0"), bronze.where("crc32(`Complaint ID`) % 2 = 1"), bronze.where("State IS NULL")]
    for k, part in enumerate(parts):
        layer.load(part, f"m{k}")
    silver = silver_complaints(bronze)
    assert rows(layer.silver(), silver.columns) == rows(silver)
    assert rows(layer.mart("gold_complaint_segments")) == rows(panel.complaint_segments(silver))
    account = layer.row_account().collect()
    assert all(r["balanced"] for r in account) and sum(r["null_keys"] for r in account) > 0


def test_an_empty_batch_and_an_empty_mart(spark, tmp_dir, loan_loads):
    layer = incremental_loans(spark, f"{tmp_dir}/loans", buckets=4)
    assert layer.load(loan_loads[0].limit(0), "none")["bronze_rows"] == 0
    assert layer.silver().count() == 0
    assert layer.mart("gold_portfolio_kpis").first()["total_loans"] == 0 and layer.mart("gold_vintage").count() == 0
    assert layer.row_account().first()["balanced"]
    assert set(LOAN_HARD_RULES) <= {r["rule"] for r in layer.rule_log().collect()}
