"""Merges of stored rows by their places, marts that share a pass, loads rendered once."""

import random

from lakepanel import queries as Q
from lakepanel.functions.mergeable import partials_of_one_pass
from lakepanel.operators import dedup
from lakepanel.plans import driver_views, incremental, marts, medallion
from lakepanel.plans.incremental import incremental_loans
from lakepanel.sources.keyed_table import KeyedTable
from pyspark.sql import functions as F


def rows(df):
    return sorted(map(repr, (tuple(r) for r in df.select(*[f"`{c}`" for c in sorted(df.columns)]).collect())))


def stored(spark, path, rng, ids, load):
    data = [(i, load, rng.choice([None, 1, 2]), rng.choice([None, "a"]), rng.choice([None, "a"])) for i in ids]
    spark.createDataFrame(data, "id long, load int, x int, `odd name` string, z string").repartition(2).write.parquet(path)
    return spark.read.parquet(path)


def test_merges_by_place_shuffle_no_whole_row_and_a_replay_rewrites_nothing(spark, tmp_dir, monkeypatch):
    plain, shuffled = dedup.latest_per_key, []

    def watched(df, *args):
        shuffled.append(set(df.columns))
        return plain(df, *args)

    monkeypatch.setattr(dedup, "latest_per_key", watched)
    rng = random.Random(4)
    table = KeyedTable(spark, f"{tmp_dir}/t", ["id"], ["-load"], buckets=4)
    # The third ties with rows of the second that have other values, null where these have one.
    batches = [stored(spark, f"{tmp_dir}/{k}", rng, ids, load) for k, (ids, load) in enumerate([(range(300), 0), (range(200, 500), 1), (range(100, 250), 1)])]
    for batch in batches:
        table.merge(batch, unique=True)
    whole = plain(batches[0].unionByName(batches[1]).unionByName(batches[2]), ["id"], ["-load"])
    assert rows(table.read()) == rows(whole) and table.read().count() == 500
    assert shuffled and not any("odd name" in columns for columns in shuffled)
    before = table.mapping()
    assert table.merge(batches[1], unique=True) == [] and table.mapping() == before
    assert rows(table.read()) == rows(whole)


def test_only_buckets_with_a_surviving_row_of_the_batch_are_rewritten(spark, tmp_dir):
    rng = random.Random(6)
    table = KeyedTable(spark, f"{tmp_dir}/t", ["id"], ["-load"], buckets=8)
    table.merge(stored(spark, f"{tmp_dir}/0", rng, range(100), 5), unique=True)
    older = stored(spark, f"{tmp_dir}/1", rng, [*range(100), 1000], 1)  # one new key, the others come too late
    first = table.mapping()
    touched = table.merge(older, unique=True)
    second = table.mapping()
    assert len(touched) == 1 and [b for b in second if second[b] != first[b]] == touched
    assert table.read().where("load = 5").count() == 100 and table.read().where("load = 1").count() == 1


def test_digests_are_read_only_where_order_columns_may_tie(spark, tmp_dir, monkeypatch):
    told = {}
    plain = dedup._ranges_meet
    monkeypatch.setattr(dedup, "_ranges_meet", lambda *args: told.setdefault(len(told), plain(*args)))
    table = KeyedTable(spark, f"{tmp_dir}/t", ["id"], ["-load"], buckets=2)
    loads = [0, 1, None, None, 1]
    batches = [spark.createDataFrame([(i, load, f"{k} {i}") for i in range(20)], "id long, load int, x string") for k, load in enumerate(loads)]
    whole = batches[0]
    for k, batch in enumerate(batches):
        batch.write.parquet(f"{tmp_dir}/{k}")
        table.merge(spark.read.parquet(f"{tmp_dir}/{k}"), unique=True)
        whole = whole.unionByName(batch) if k else batch
        assert rows(table.read()) == rows(dedup.latest_per_key(whole, ["id"], ["-load"])), k
    assert told == {0: False, 1: False, 2: False, 3: True}  # nulls come last and never survive here
    nulls = [spark.createDataFrame([(1, None, x)], "id long, load int, x string") for x in "ba"]
    for k, df in enumerate(nulls):
        df.write.parquet(f"{tmp_dir}/n{k}")
    marks = dedup.lost_places(*[spark.read.parquet(f"{tmp_dir}/n{k}") for k in range(2)], ["id"], ["-load"])
    assert told[4] and rows(dedup.without_places(spark.read.parquet(f"{tmp_dir}/n0"), marks)) == []
    assert len(rows(dedup.without_places(spark.read.parquet(f"{tmp_dir}/n1"), marks))) == 1  # the smaller x stays


def test_marts_of_one_pass_equal_each_marts_own_partials(spark):
    rng = random.Random(8)
    pick = rng.choice

    def row(i):
        d = f"20{rng.randint(10, 12)}-{rng.randint(1, 3):02d}-{pick(['01', '17'])}"
        return (i % 3, pick([None, "A", "B", "H"]), pick([None, "car", "house"]), pick([None, "ASIA", "EUROPE"]), pick([None, d, d]), rng.random() * 9e4,
                pick([None, float("nan"), 1e30, 1.005, rng.random() * 9e4]), pick([None, rng.random() * 30]), pick([None, 600.5, 700.0, 790.0]),
                pick([None, -1.0, 5.5, 25.0, 99.0]), pick([0, 1]), pick([0, 1]), rng.random() * 99, pick([None, rng.random() - 0.5]))

    schema = ("b int, grade string, purpose string, addr_state string, day string, loan_amnt double, funded_amnt double, int_rate double, fico_avg double,"
              "dti double, is_default int, is_resolved int, charge_off_loss double, net_cash double")
    df = spark.createDataFrame([row(i) for i in range(400)], schema).withColumn("issue_date", F.to_date("day"))
    known, passes = marts.loan_marts(), marts.loan_passes()
    assert sorted(n for names, _ in passes for n in names) == sorted(known)
    for names, grain in passes:
        kept = []
        got = partials_of_one_pass({n: known[n] for n in names}, df, ["b"], grain, lambda c: kept.append(c) or c)
        assert len(kept) == 1  # one aggregate of the rows for all of them
        for n in names:
            expected = known[n].partial(df, "b")
            assert got[n].dtypes == expected.dtypes and rows(got[n]) == rows(expected), n


def test_a_merge_aggregates_its_rows_once_per_pass(spark, tmp_dir, monkeypatch):
    calls = []
    plain = incremental.partials_of_one_pass
    monkeypatch.setattr(incremental, "partials_of_one_pass", lambda m, *args: calls.append(sorted(m)) or plain(m, *args))
    raw = made_loans(spark, tmp_dir).withColumns({"_source_file": F.lit("f"), "_ingested_at": F.lit("2024-01-01").cast("timestamp")})
    raw.write.parquet(f"{tmp_dir}/bronze")
    layer = incremental_loans(spark, f"{tmp_dir}/loans", buckets=2)
    layer.load(spark.read.parquet(f"{tmp_dir}/bronze"), "one")
    assert len(calls) == 2 and sorted(sum(calls, [])) == sorted(layer.marts)
    assert rows(layer.mart("gold_purpose_risk")) == rows(marts.purpose_risk(layer.silver()))
    assert rows(layer.mart("gold_loan_segments")) == rows(marts.loan_marts()["gold_loan_segments"].whole(layer.silver()))


def made_loans(spark, folder, size=120):
    day = "to_timestamp_ntz(date_add(date'2020-01-15', cast(id % 400 as int))) AS"
    made = {
        "region": "id r_regionkey, 'ASIA' r_name",
        "nation": "cast(id as int) n_nationkey, 'CHINA' n_name, cast(0 as int) n_regionkey",
        "customer": "id c_custkey, 'C' c_name, cast(0 as int) c_nationkey, 10.5D c_acctbal, 'AUTO' c_mktsegment",
        "orders": f"if(id = 3, null, id) o_orderkey, 0L o_custkey, 'F' o_orderstatus, 99.5D o_totalprice, {day} o_orderdate, '1-URGENT' o_orderpriority",
    }
    for name, columns in made.items():
        n = size if name == "orders" else 1
        spark.range(n).selectExpr(f"inline(array(struct({columns})))").coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return driver_views.loans_bronze(spark, folder).drop("_ingested_at", "_source_file")


def test_the_three_loads_come_from_one_rendering_and_no_stored_copy_of_the_view(spark, tmp_dir):
    raw = made_loans(spark, tmp_dir)
    ids = {int(r["id"]) for r in raw.select("id").collect()}
    loads = [spark.read.parquet(path) for path in Q._loan_loads(spark, tmp_dir)]
    assert not any(key[1] == tmp_dir and key[3] == "bronze/loans" for key in medallion._TABLES)
    got = [[(r["id"], r["loan_status"], r["loan_amnt"]) for r in load.collect()] for load in loads]
    by_id = {int(r["id"]): (r["loan_status"], r["loan_amnt"]) for r in raw.collect()}
    first = [(str(i), *by_id[i]) for i in ids if i % 3 != 2]
    second = [(str(i), "Charged Off" if i % 5 == 0 else by_id[i][0], by_id[i][1]) for i in ids if i % 3 == 2 or i % 5 == 0]
    third = [("x" if i % 35 == 0 else str(i), by_id[i][0], "0" if i % 2 == 0 else by_id[i][1]) for i in ids if i % 7 == 0]
    assert [sorted(map(repr, x)) for x in got] == [sorted(map(repr, x)) for x in (first, second, third)]
    for k, load in enumerate(loads, start=1):
        assert load.columns == [*raw.columns, "_ingested_at", "_source_file"]
        assert [tuple(r) for r in load.select("_source_file", F.col("_ingested_at").cast("string")).distinct().collect()] == [(f"load_{k}", f"2024-01-0{k} 00:00:00")]


def test_rows_of_many_repeated_keys_are_told_apart_before_they_are_typed(spark, tmp_dir):
    spark.createDataFrame([(str(i % 50), i) for i in range(80)], "id string, x int").write.parquet(f"{tmp_dir}/t")

    def typed(source):
        return source.selectExpr("try_cast(id as bigint) AS id", "sha2(string(x), 256) AS typed")

    source = spark.read.parquet(f"{tmp_dir}/t")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        got = dedup.latest_per_key_of_stored(typed(source), ["id"], ["typed"], source, typed)
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert rows(got) == rows(dedup.latest_per_key(typed(source), ["id"], ["typed"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    branches = plan.split("sha2(")[1:]
    assert len(branches) == 2 and "LeftAnti" in branches[0] and "LeftSemi" in branches[1]
