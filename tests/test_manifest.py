"""Atomic switches of tables and the batch manifest: what a crash or a refusal leaves behind."""

import os

import pytest
from lakepanel.operators.quality import RowFloorError
from lakepanel.plans.lakehouse import Lakehouse
from lakepanel.sources import sinks, versions
from lakepanel.sources.sinks import save_table
from lakepanel.sources.versions import current, read_version, write_version
from lakepanel.streaming.ingest import EvolvingCsvIngest
from pyspark.sql import SparkSession


class Crash(BaseException):
    pass


def land(folder, name, rows, header="id,v"):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write("\n".join([header, *rows]) + "\n")


def ids(df):
    return sorted(r["id"] for r in df.collect())


# ------------------------------------------------------------- pointer switch
def test_versioned_folder(spark, tmp_dir):
    folder = f"{tmp_dir}/t"
    for n in (10, 4, 7):
        write_version(spark.range(n), folder)
        assert read_version(spark, folder).count() == n
    kept = [d for d in os.listdir(folder) if d.startswith("data_")]
    assert len(kept) == 2  # the current one, and the one that readers may still hold
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        write_version(spark.sql("SELECT 1 / (id - 3) AS id FROM range(5)"), folder)
    assert read_version(spark, folder).count() == 7 and len(os.listdir(folder)) == 3


@pytest.mark.parametrize("step", ["point_to", "forget_old"])
def test_a_crash_at_any_step_leaves_a_readable_folder(spark, tmp_dir, monkeypatch, step):
    folder = f"{tmp_dir}/t"
    write_version(spark.range(10), folder)
    reader = read_version(spark, folder)

    def die(*args, **kwargs):
        raise Crash

    for when in ("before", "after"):
        with monkeypatch.context() as m:
            real = getattr(versions, step)

            def dying(*args, real=real, when=when, **kwargs):
                if when == "after":
                    real(*args, **kwargs)
                raise Crash

            m.setattr(versions, step, dying)
            with pytest.raises(Crash):
                write_version(spark.range(4), folder)
        assert read_version(spark, folder).count() in (10, 4)
        assert reader.count() == 10  # begun before the switch
        write_version(spark.range(10), folder)
        reader = read_version(spark, folder)


def test_a_crash_between_any_two_catalog_statements_leaves_a_readable_table(spark, monkeypatch):
    spark.sql("CREATE DATABASE IF NOT EXISTS switch_test")
    name = "switch_test.t"
    frame = lambda n, extra: spark.range(n).selectExpr("id", "id % 2 AS p", *extra)
    save_table(frame(10, []), name, comment="first", quality="gold", partition_by=["p"])
    real, seen = SparkSession.sql, []
    old, new = {10}, {4}
    for k in range(1, 12):
        calls = []

        def dying(self, query, *args, calls=calls, k=k, **kwargs):
            if query.startswith(("CREATE", "ALTER", "DROP", "MSCK", "COMMENT")):
                calls.append(query)
                if len(calls) == k:
                    raise Crash(query)
            return real(self, query, *args, **kwargs)

        with monkeypatch.context() as m:
            m.setattr(type(spark), "sql", dying)
            try:
                save_table(frame(4, ["'x' AS more"]), name, comment="second", quality="gold", partition_by=["p"])
                finished = True
            except Crash:
                finished = False
        seen.append(finished)
        got = spark.table(name)
        assert got.count() in old | new
        assert ("more" in got.columns) == (got.count() in new)  # rows and columns switch together
        about = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
        assert about["Comment"] == ("second" if got.count() in new else "first")
        if finished:
            break
        save_table(frame(10, []), name, comment="first", quality="gold", partition_by=["p"])
    assert seen[-1] and len(seen) >= 4
    versions_left = [t.name for t in spark.catalog.listTables("switch_test__versions") if not t.isTemporary and t.name.startswith("t__v")]
    assert len(versions_left) <= 3
    spark.sql("DROP DATABASE switch_test CASCADE")
    spark.sql("DROP DATABASE switch_test__versions CASCADE")


def test_a_plain_table_of_the_name_is_replaced_once(spark, tmp_dir):
    spark.sql("CREATE DATABASE IF NOT EXISTS plain_test")
    spark.sql("CREATE TABLE plain_test.t USING parquet AS SELECT 1 AS a")
    save_table(spark.range(3), "plain_test.t")
    assert spark.table("plain_test.t").count() == 3
    spark.sql("DROP DATABASE plain_test CASCADE")
    spark.sql("DROP DATABASE plain_test__versions CASCADE")


# ------------------------------------------------------------- batch manifest
@pytest.fixture
def ingest(tmp_dir):
    return EvolvingCsvIngest(f"{tmp_dir}/landing/*.csv", f"{tmp_dir}/bronze", f"{tmp_dir}/ck", id_col="id")


def test_rows_and_columns_come_from_manifests(spark, tmp_dir, ingest, monkeypatch):
    land(f"{tmp_dir}/landing", "a.csv", ["1,x", "2,y", "Total,"])
    assert ingest.run(spark) == 2
    land(f"{tmp_dir}/landing", "b.csv", ["3,n,z"], header="id,note,v")
    assert ingest.run(spark) == 3
    assert ingest.run(spark) == 3  # nothing new
    shown = ingest.manifests(spark)
    assert [(m["row_count"], m["file_count"], m["rejected_count"]) for m in shown] == [(2, 1, 0), (1, 1, 0)]
    bronze = ingest.read_bronze(spark)
    assert bronze.columns == ["id", "v", "note", "_ingested_at", "_source_file", "batch_id"]
    assert sorted(tuple(r)[:3] for r in bronze.collect()) == [("1", "x", None), ("2", "y", None), ("3", "z", "n")]
    # The schema is declared: reading plans no footer sweep.
    monkeypatch.setattr(type(spark.read), "option", lambda self, k, v, f=type(spark.read).option: pytest.fail(k) if k == "mergeSchema" else f(self, k, v))
    assert ingest.read_bronze(spark).count() == 3


def test_a_batch_without_its_manifest_does_not_count(spark, tmp_dir, ingest, monkeypatch):
    land(f"{tmp_dir}/landing", "a.csv", ["1,x"])
    ingest.run(spark)
    land(f"{tmp_dir}/landing", "b.csv", ["2,y"])
    paths = spark.createDataFrame([(f"{tmp_dir}/landing/b.csv",)], "path string")

    class Dying(EvolvingCsvIngest):
        @property
        def manifest_path(self):
            raise Crash

    dying = Dying(ingest.landing_glob, ingest.bronze_path, ingest.checkpoint_path, id_col="id")
    with pytest.raises(Crash):
        dying._write_batch(paths, 1)
    assert os.path.isdir(f"{ingest.bronze_path}/batch_id=1")  # its data is there
    assert ids(ingest.read_bronze(spark)) == ["1"]
    ingest.run(spark)  # the stream takes the batch again
    assert ids(ingest.read_bronze(spark)) == ["1", "2"]


def test_a_load_below_the_floor_does_not_show(spark, tmp_dir, ingest):
    land(f"{tmp_dir}/landing", "a.csv", ["1,x", "2,y"])
    with pytest.raises(RowFloorError):
        ingest.run(spark, row_floor=3)
    assert ids(ingest.read_bronze(spark)) == []
    land(f"{tmp_dir}/landing", "b.csv", ["3,x", "4,y"])
    assert ingest.run(spark, row_floor=3) == 4
    assert ids(ingest.read_bronze(spark)) == ["1", "2", "3", "4"]
    assert current(spark, ingest.manifest_path) == "through=1"


def test_a_mended_file_is_taken_again(spark, tmp_dir, ingest):
    land(f"{tmp_dir}/landing", "good.csv", ["1,x"])
    land(f"{tmp_dir}/landing", "bad.csv", ["2,y"], header="ID ,v")
    land(f"{tmp_dir}/landing", "worse.csv", ["3,z"], header="key,v")
    ingest.run(spark)
    assert ids(ingest.read_bronze(spark)) == ["1"]
    assert ingest.retry_rejected(spark) == []
    land(f"{tmp_dir}/landing", "bad.csv", ["2,y"])
    assert [p.rsplit("/", 1)[1] for p in ingest.retry_rejected(spark)] == ["bad.csv"]
    assert ids(ingest.read_bronze(spark)) == ["1", "2"]
    left = spark.read.parquet(ingest.rejected_path).collect()
    assert [(r["path"].rsplit("/", 1)[1], r["reason"]) for r in left] == [("worse.csv", "no column id")]


def test_many_header_groups_and_a_quoted_header(spark, tmp_dir, ingest):
    land(f"{tmp_dir}/landing", "a.csv", ['1,"x\ny"'])
    land(f"{tmp_dir}/landing", "b.csv", ["p,2,q"], header='"odd\nname",id,v')
    land(f"{tmp_dir}/landing", "c.csv", ["3"], header="id")
    land(f"{tmp_dir}/landing", "d.csv", [], header="id,late")
    land(f"{tmp_dir}/landing", "e.csv", ["4,a,b,more"], header="id,v,w")
    ingest.run(spark)
    rows = {r["id"]: r.asDict() for r in ingest.read_bronze(spark).collect()}
    assert rows["1"]["v"] == "x\ny" and rows["2"]["odd\nname"] == "p" and rows["2"]["v"] == "q"
    assert rows["3"]["v"] is None and rows["4"]["w"] == "b" and "late" in rows["4"]


def test_lakehouse_bronze_in_a_catalog_grows_by_partitions(spark, tmp_dir):
    spark.sql("CREATE DATABASE IF NOT EXISTS grow_test")
    lake = Lakehouse(spark, root=f"{tmp_dir}/lake", database="grow_test")
    for k, (rows, header) in enumerate([(["1,x"], "id,v"), (["2,n,y"], "id,note,v"), (["3,z"], "id,v")]):
        land(f"{tmp_dir}/landing", f"f{k}.csv", rows, header)
        lake._bronze_stream(f"{tmp_dir}/landing/*.csv", "bronze_loans", None, "id")
        assert lake.report["bronze_loans_rows"] == k + 1
    rows = sorted((r["id"], r["v"], r["note"]) for r in spark.table("grow_test.bronze_loans").collect())
    assert rows == [("1", "x", None), ("2", "y", "n"), ("3", "z", None)]
    land(f"{tmp_dir}/landing", "g.csv", ["4,x"])
    with pytest.raises(RowFloorError):
        lake._bronze_stream(f"{tmp_dir}/landing/*.csv", "bronze_loans", 100, "id")
    assert spark.table("grow_test.bronze_loans").count() == 3
    spark.sql("DROP DATABASE grow_test CASCADE")


def test_views_carry_comment_and_layer_in_one_statement(spark, monkeypatch):
    seen = []
    real = SparkSession.sql
    monkeypatch.setattr(type(spark), "sql", lambda self, q, *a, **k: (seen.append(q), real(self, q, *a, **k))[1])
    sinks.save_view(spark, "default.one_statement", "SELECT 1 AS a", "it's", "gold")
    assert len(seen) == 1
    monkeypatch.undo()
    spark.sql("DROP VIEW default.one_statement")
