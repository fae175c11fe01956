"""De-duplication and merges of stored rows: equal rows, and only what has to be shuffled."""

import glob
import random

import pyarrow.parquet as pq
from lakepanel.operators import dedup
from lakepanel.plans import driver_views
from lakepanel.session import small_pieces
from lakepanel.sources import sinks, tables
from lakepanel.sources.keyed_table import BUCKET, KeyedTable
from pyspark.sql import functions as F


def rows(df):
    return sorted(map(repr, df.collect()))


def test_only_rows_of_repeated_keys_are_sorted(spark, tmp_dir):
    rng = random.Random(5)
    data = [(rng.choice([None, *range(60)]), rng.randint(0, 2), rng.choice(["a", "b", None])) for _ in range(90)]
    spark.createDataFrame(data, "id long, load int, `odd name` string").write.parquet(f"{tmp_dir}/t")
    df = spark.read.parquet(f"{tmp_dir}/t")
    got = dedup.latest_per_key_of_stored(df, ["id"], ["-load"])
    assert got.columns == df.columns
    assert rows(got) == rows(dedup.latest_per_key(df, ["id"], ["-load"]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # many repeated keys: the plain way
    try:
        many = dedup.latest_per_key_of_stored(df, ["id"], ["-load"])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Join" not in many._jdf.queryExecution().executedPlan().toString()
    assert rows(many) == rows(got)
    unique = dedup.latest_per_key_of_stored(df.dropDuplicates(["id"]).dropna(subset=["id"]), ["id"], ["-load"])
    assert "BroadcastHashJoin" in unique._jdf.queryExecution().executedPlan().toString()


def test_many_repeated_keys_are_told_apart_by_their_places(spark, tmp_dir, monkeypatch):
    rng = random.Random(9)
    keys = [None, *range(400), *range(300), *range(5)]
    data = [(k, rng.randint(0, 1), rng.choice(["a", "b", None])) for k in keys]
    spark.createDataFrame(data, "id long, load int, `odd name` string").repartition(3).write.parquet(f"{tmp_dir}/t")
    # A file of more rows than a page of marks, all keys its own but the last.
    far = spark.range(1000, 71_000).selectExpr("if(id = 70999, 399, id) AS id", "2 AS load", "'far' AS `odd name`")
    far.coalesce(1).write.mode("append").parquet(f"{tmp_dir}/t")
    df = spark.read.parquet(f"{tmp_dir}/t").selectExpr("id", "load", "upper(`odd name`) AS `odd name`")
    plain, sorted_rows = dedup.latest_per_key, []

    def watched(rows, *args):
        sorted_rows.append(rows.count())
        return plain(rows, *args)

    monkeypatch.setattr(dedup, "latest_per_key", watched)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        got = dedup.latest_per_key_of_stored(df, ["id"], ["-load"])
        assert got.columns == df.columns
        assert rows(got) == rows(plain(df, ["id"], ["-load"]))
        assert sorted_rows == [607]  # 300 keys twice, five of them three times, and the key 399
        # Rows of two tables have no place: all of them are sorted.
        both = dedup.latest_per_key_of_stored(df.unionByName(df), ["id"], ["-load"])
        assert rows(both) == rows(got) and sorted_rows[1:] == [70_705 * 2]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_first_merge_of_unique_rows_needs_no_shuffle_and_later_ones_one(spark, tmp_dir, monkeypatch):
    seen = []
    plain = KeyedTable.with_bucket

    def watched(self, df):
        out = plain(self, df)
        seen.append(out)
        return out

    monkeypatch.setattr(KeyedTable, "with_bucket", watched)
    table = KeyedTable(spark, f"{tmp_dir}/k", ["id"], ["-load"], buckets=4)
    spark.range(100).selectExpr("id", "0 AS load").write.parquet(f"{tmp_dir}/b")
    table.merge(spark.read.parquet(f"{tmp_dir}/b"), unique=True)
    # The batch itself: no second de-duplication before its bucket is known.
    assert "Exchange" not in seen[0]._jdf.queryExecution().executedPlan().toString()
    table.merge(spark.range(50, 150).selectExpr("id", "1 AS load"))
    assert table.read().count() == 150 and table.read().where("load = 1").count() == 100
    assert BUCKET not in table.read().columns


def test_csv_files_hold_no_more_records_than_asked(spark, tmp_dir):
    sinks.write_csv(spark.range(25).coalesce(1), f"{tmp_dir}/csv", max_records=10)
    read = spark.read.option("header", "true").csv(f"{tmp_dir}/csv")
    assert read.count() == 25
    most = read.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert most == 10


def test_a_merge_shuffles_only_rows_whose_key_both_sides_have(spark, tmp_dir, monkeypatch):
    table = KeyedTable(spark, f"{tmp_dir}/k", ["id"], ["-load"], buckets=4)
    for load, (first, last) in enumerate([(0, 3000), (2990, 6000)]):
        made = spark.range(first, last).selectExpr("id", f"{load} AS load", "repeat('x', 50) AS body")
        made.write.parquet(f"{tmp_dir}/{load}")
    table.merge(spark.read.parquet(f"{tmp_dir}/0"), unique=True)
    plans = []
    plain = dedup.latest_per_key

    def watched(df, *args):
        plans.append(df.count())
        return plain(df, *args)

    monkeypatch.setattr(dedup, "latest_per_key", watched)
    table.merge(spark.read.parquet(f"{tmp_dir}/1"), unique=True)
    assert plans == [20]
    got = table.read().groupBy("load").count().orderBy("load").collect()
    assert [tuple(r) for r in got] == [(0, 2990), (1, 3010)]


def test_rows_of_one_row_group_are_dealt_to_many_tasks(spark, tmp_dir, monkeypatch):
    spark.range(1000).selectExpr("id", "id % 7 AS n").coalesce(1).write.parquet(f"{tmp_dir}/t")
    df = spark.read.parquet(f"{tmp_dir}/t")
    dealt = tables.spread_rows(df, ["id"], rows_per_task=100)
    assert dealt.rdd.getNumPartitions() == 10 and rows(dealt) == rows(df)
    assert max(dealt.rdd.mapPartitions(lambda p: [sum(1 for _ in p)]).collect()) < 200
    assert tables.spread_rows(df, ["id"]).rdd.getNumPartitions() == 1


def test_driver_views_are_rendered_by_many_tasks(spark, tmp_dir, monkeypatch):
    day = "to_timestamp_ntz(date_add(date'2020-01-15', cast(id % 400 as int))) AS"
    made = {
        "region": "id r_regionkey, 'ASIA' r_name",
        "nation": "cast(id as int) n_nationkey, 'CHINA' n_name, cast(0 as int) n_regionkey",
        "customer": "id c_custkey, 'C' c_name, cast(0 as int) c_nationkey, 10.5D c_acctbal, 'AUTO' c_mktsegment",
        "supplier": "id s_suppkey, 'S' s_name, cast(0 as int) s_nationkey, 1.5D s_acctbal",
        "orders": f"id o_orderkey, 0L o_custkey, 'F' o_orderstatus, 99.5D o_totalprice, {day} o_orderdate, '1-URGENT' o_orderpriority",
        "lineitem": "id % 40 l_orderkey, id l_partkey, 0L l_suppkey, cast(id % 3 as int) l_linenumber, 5D l_quantity, "
                    f"'R' l_returnflag, 'F' l_linestatus, {day} l_shipdate",
    }
    for name, columns in made.items():
        size = 200 if name in ("orders", "lineitem") else 1
        row = spark.range(size).selectExpr(f"inline(array(struct({columns})))")
        row.coalesce(1).write.parquet(f"{tmp_dir}/{name}.parquet")
    views = [driver_views.loans_bronze, driver_views.complaints_bronze]
    before = [rows(v(spark, tmp_dir).drop("_ingested_at")) for v in views]
    plain = tables.spread_rows
    monkeypatch.setattr(driver_views, "spread_rows", lambda df, by: plain(df, by, rows_per_task=30))
    for view, expected in zip(views, before):
        got = view(spark, tmp_dir)
        assert "REPARTITION_BY_NUM" in got._jdf.queryExecution().executedPlan().toString()
        assert len(expected) == 200 and rows(got.drop("_ingested_at")) == expected


def test_stored_tables_of_a_build_have_small_row_groups(spark, tmp_dir):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert spark.conf.get("parquet.block.size", None) is None
    with small_pieces(spark):
        assert int(spark.conf.get(key)) >= 1000
        spark.range(1_000_000).selectExpr("id", "sha2(string(id), 256) AS body").coalesce(1).write.parquet(f"{tmp_dir}/t")
        read = spark.read.parquet(f"{tmp_dir}/t")
        per_task = read.rdd.mapPartitions(lambda p: [sum(1 for _ in p)]).collect()
    assert sum(per_task) == 1_000_000 and max(per_task) < 500_000
    assert spark.conf.get("parquet.block.size", None) is None and spark.conf.get(key, None) is None


def test_builds_write_no_dictionaries_and_wide_steps_without_one_large_method(spark, tmp_dir):
    def wide_plan():
        wide = spark.read.parquet(f"{tmp_dir}/t").select("*", *[(F.col("id") + k).alias(f"c{k}") for k in range(40)])
        return wide._jdf.queryExecution().executedPlan().toString()

    settings = ["parquet.enable.dictionary", "spark.sql.codegen.maxFields"]
    before = [spark.conf.get(s, None) for s in settings]
    with small_pieces(spark):
        spark.range(500).selectExpr("id", "concat('loan ', id % 9) AS body").coalesce(1).write.parquet(f"{tmp_dir}/t")
        assert "*(1) Project" not in wide_plan()
    assert [spark.conf.get(s, None) for s in settings] == before
    assert "*(1) Project" in wide_plan()
    assert spark.read.parquet(f"{tmp_dir}/t").groupBy("body").count().count() == 9
    (file,) = glob.glob(f"{tmp_dir}/t/*.parquet")
    group = pq.ParquetFile(file).metadata.row_group(0)
    assert not any(group.column(c).has_dictionary_page for c in range(2))
