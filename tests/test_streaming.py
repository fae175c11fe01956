"""Incremental CSV ingest with schema growth."""

import csv
import os

from lakepanel.streaming.ingest import EvolvingCsvIngest


def land(path, header, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as fh:
        w = csv.writer(fh)
        w.writerow(header)
        w.writerows(rows)


def test_rerun_new_file_and_new_middle_column(spark, tmp_dir):
    ing = EvolvingCsvIngest(f"{tmp_dir}/landing/*/*.csv", f"{tmp_dir}/bronze", f"{tmp_dir}/ckpt", id_col="id")
    land(f"{tmp_dir}/landing/m1/a.csv", ["id", "desc", "amt"], [["1", "multi\nline, \"q\"", "9"], ["Total", "", ""]])
    ing.run(spark)
    b = ing.read_bronze(spark)
    assert [(r["id"], r["desc"], r["amt"]) for r in b.collect()] == [("1", 'multi\nline, "q"', "9")]
    assert b.first()["_source_file"].endswith("a.csv")

    ing.run(spark)  # nothing new
    assert ing.read_bronze(spark).count() == 1

    # A new column in the middle: must bind by name, not by position.
    land(f"{tmp_dir}/landing/m2/b.csv", ["id", "note", "desc", "amt"], [["2", "N", "foo", "7"]])
    ing.run(spark)
    got = {r["id"]: r.asDict() for r in ing.read_bronze(spark).collect()}
    assert sorted(got) == ["1", "2"]
    assert got["2"]["desc"] == "foo" and got["2"]["amt"] == "7" and got["2"]["note"] == "N"
    assert got["1"]["note"] is None


def test_a_replayed_batch_rewrites_itself(spark, tmp_dir):
    # After a driver failure between a batch's write and its commit, the stream
    # replays the same batch id with the same files: the output must not double.
    ing = EvolvingCsvIngest(f"{tmp_dir}/landing/*/*.csv", f"{tmp_dir}/bronze", f"{tmp_dir}/ckpt", id_col="id")
    land(f"{tmp_dir}/landing/m1/a.csv", ["id", "desc"], [["1", "x"], ["2", "y"]])
    land(f"{tmp_dir}/landing/m1/b.csv", ["id", "note", "desc"], [["3", "n", "z"]])
    paths = spark.createDataFrame([(f"file:{tmp_dir}/landing/m1/a.csv",), (f"file:{tmp_dir}/landing/m1/b.csv",)], "path string")
    ing._write_batch(paths, 0)
    ing._write_batch(paths, 0)  # the replay
    got = sorted((r["id"], r["desc"], r["note"]) for r in ing.read_bronze(spark).collect())
    assert got == [("1", "x", None), ("2", "y", None), ("3", "z", "n")]


def test_a_backlog_drains_in_bounded_batches(spark, tmp_dir):
    # availableNow with maxFilesPerTrigger=1: three files land as three batches,
    # so one batch never brings more than one path to the driver.
    ing = EvolvingCsvIngest(f"{tmp_dir}/landing/*/*.csv", f"{tmp_dir}/bronze", f"{tmp_dir}/ckpt",
                            id_col="id", max_files_per_trigger=1)
    for i in range(3):
        land(f"{tmp_dir}/landing/m{i}/f.csv", ["id", "desc"], [[str(i), f"row {i}"]])
    ing.run(spark)
    bronze = ing.read_bronze(spark)
    assert sorted(r["id"] for r in bronze.collect()) == ["0", "1", "2"]
    assert bronze.select("batch_id").distinct().count() == 3
