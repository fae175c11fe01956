"""Safe publishing, rounding once, survivor precedence, stream robustness, shared storage."""

import os
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

import pytest
from lakepanel.functions import derive
from lakepanel.functions import metrics as M
from lakepanel.operators.quality import RowFloorError
from lakepanel.plans import medallion
from lakepanel.plans.complaints import silver_complaints
from lakepanel.plans.lakehouse import Lakehouse
from lakepanel.constants import COMPLAINT_RENAMES
from lakepanel.session import ensure_checkpoint_dir
from lakepanel.sources.sinks import save_table, write_table
from lakepanel.streaming.ingest import EvolvingCsvIngest
from pyspark.sql import functions as F


def _exact(num, den, digits):
    q = Fraction(str(num)) / Fraction(str(den))
    unit = Fraction(1, 10**digits)
    whole = int((abs(q) / unit + Fraction(1, 2)) // 1)
    return float(Decimal(whole if q >= 0 else -whole).scaleb(-digits).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))


def test_ratios_round_once(spark):
    rows = [(11396.87, 69547.9), (100.0, 0.004), (15.20285, 12.0), (1.0, 0.0), (1.0, None), (None, 5.0), (333.33, 3.0), (-5.0, 3.0)]
    df = spark.createDataFrame(rows, "i double, a double")
    got = [r[0] for r in df.select(derive.installment_to_income("i", "a")).collect()]
    want = [_exact(Fraction(str(i)) * 12, a, 4) if i is not None and a else None for i, a in rows]
    assert got == want
    rate = spark.range(1).select(M.null_safe_rate(F.lit(123449996), F.lit(1000000000))).first()[0]
    assert rate == 12.34


def test_the_quick_ratio_equals_the_exact_one(spark):
    import random

    from lakepanel.functions.metrics import dec, round_ratio

    rng = random.Random(12)
    rows = [(rng.choice([1, 1, 1, -1]) * round(rng.uniform(0, 2000), rng.randint(0, 10)), round(rng.uniform(0, 10 ** rng.randint(-3, 6)), rng.randint(0, 10))) for _ in range(3000)]
    # On and next to rounding edges, tiny, huge and odd values.
    rows += [(b * k / 240000 + e, b) for b in (1.0, 12.0, 480.0, 60000.0, 0.25) for k in range(1, 60, 2) for e in (0, 1e-9, -1e-9, 1e-7)]
    rows += [(1e-9, 1.0), (1.0, 1e-9), (1e12, 1.0), (1.0, 1e16), (float("nan"), 1.0), (1.0, float("nan")), (float("inf"), 2.0), (0.0, 5.0), (-0.0, 5.0)]
    df = spark.createDataFrame(rows, "i double, a double")
    income = dec("a", "decimal(24,8)")
    exact = round_ratio(dec("i", "decimal(20,8)") * F.lit(12).cast("decimal(2,0)"), F.when(income > 0, income), 4)
    out = df.select("i", "a", derive.installment_to_income("i", "a").alias("quick"), exact.alias("exact"))
    assert [tuple(r) for r in out.where("NOT quick <=> exact").collect()] == []


def test_values_left_out_of_sums_are_counted(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (1e30,), (None,)], "x double")
    assert df.agg(M.count_unfit("x")).first()[0] == 2


def test_failed_write_keeps_the_old_table(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    write_table(spark.range(10), path)
    bad = spark.range(5).select((F.lit(1) / (F.col("id") - 3)).alias("id"))
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        write_table(bad, path)

    def refuse():
        raise RowFloorError("too few")

    with pytest.raises(RowFloorError):
        write_table(spark.range(2), path, check=refuse)
    assert spark.read.parquet(path).count() == 10
    assert os.listdir(tmp_dir) == ["t"]
    write_table(spark.range(3), path)
    assert spark.read.parquet(path).count() == 3


def test_failed_catalog_write_keeps_the_old_table(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS publish_test")
    name = "publish_test.t"
    save_table(spark.range(10), name, comment="ten", quality="gold")
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        save_table(spark.range(5).select((F.lit(1) / (F.col("id") - 3)).alias("id")), name)
    assert spark.table(name).count() == 10
    save_table(spark.range(4), name)
    assert spark.table(name).count() == 4
    # Other queries' temporary views are listed in every database.
    assert [t.name for t in spark.catalog.listTables("publish_test") if not t.isTemporary] == ["t"]
    spark.sql("DROP DATABASE publish_test CASCADE")


def _loans(folder, name, ids, header="id,loan_amnt"):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.csv", "w") as f:
        f.write(header + "\n" + "".join(f"{i},100\n" for i in ids))


def test_load_below_the_floor_keeps_stored_bronze(spark, tmp_dir):
    lake = Lakehouse(spark, root=f"{tmp_dir}/lake")
    lake._bronze(spark.range(100), "bronze_x", row_floor=50)
    with pytest.raises(RowFloorError):
        lake._bronze(spark.range(1), "bronze_x", row_floor=50)
    assert lake.read("bronze_x", "bronze").count() == 100


@pytest.mark.parametrize("bulk,history", [("Alpha", "Zeta"), ("Zeta", "Alpha")])
def test_complaint_survivor_follows_precedence_not_the_company(spark, bulk, history):
    raw = {new: old for old, new in COMPLAINT_RENAMES.items()}
    rows = [("1", bulk, "bulk.csv"), ("1", history, "a_history.csv")]
    df = spark.createDataFrame(rows, f"`{raw['complaint_id']}` string, `{raw['company']}` string, _source_file string")
    df = df.withColumns({old: F.lit(None).cast("string") for old in COMPLAINT_RENAMES if old not in df.columns})
    df = df.withColumn("_ingested_at", F.lit("2024-01-01").cast("timestamp"))
    got = silver_complaints(df).collect()
    assert [r["company"] for r in got] == [bulk] and "_source_file" not in got[0].asDict()
    assert [r["company"] for r in silver_complaints(df, precedence=("_source_file",)).collect()] == [history]


def test_bad_file_is_set_aside_and_the_rest_lands(spark, tmp_dir):
    landing = f"{tmp_dir}/landing"
    _loans(landing, "good", [1, 2])
    _loans(landing, "bad", [3], header="ID ,loan_amnt")
    ingest = EvolvingCsvIngest(f"{landing}/*.csv", f"{tmp_dir}/bronze", f"{tmp_dir}/ck", id_col="id")
    ingest.run(spark)
    assert sorted(r["id"] for r in ingest.read_bronze(spark).collect()) == ["1", "2"]
    rejected = spark.read.parquet(ingest.rejected_path).collect()
    assert [r["path"].rsplit("/", 1)[1] for r in rejected] == ["bad.csv"]
    _loans(landing, "more", [4])
    ingest.run(spark)
    assert ingest.read_bronze(spark).count() == 3


def test_incremental_bronze_as_a_catalog_table(spark, tmp_dir):
    spark.sql("CREATE DATABASE IF NOT EXISTS stream_test")
    lake = Lakehouse(spark, root=f"{tmp_dir}/lake", database="stream_test")
    _loans(f"{tmp_dir}/landing", "a", [1, 2])
    lake._bronze_stream(f"{tmp_dir}/landing/*.csv", "bronze_loans", None, "id")
    assert spark.table("stream_test.bronze_loans").count() == 2
    _loans(f"{tmp_dir}/landing", "b", [3], header="id,extra")
    lake._bronze_stream(f"{tmp_dir}/landing/*.csv", "bronze_loans", None, "id")
    assert sorted((r["id"], r["extra"]) for r in spark.table("stream_test.bronze_loans").collect()) == [("1", None), ("2", None), ("3", "100")]
    spark.sql("DROP DATABASE stream_test CASCADE")


def test_cluster_without_a_shared_folder_is_refused():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_stored_layers_follow_their_input(spark, tmp_dir):
    spark.range(3).write.parquet(f"{tmp_dir}/t.parquet")
    calls = []
    write = lambda path: calls.append(path)
    first = medallion.stored(spark, tmp_dir, "x", write)
    assert medallion.stored(spark, tmp_dir, "x", write) == first and len(calls) == 1
    spark.range(4).write.mode("overwrite").parquet(f"{tmp_dir}/t.parquet")
    assert medallion.stored(spark, tmp_dir, "x", write) != first and len(calls) == 2
