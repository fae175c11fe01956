"""Parallel read of quoted CSV: equal to the multi-line reader, whatever the splits."""

import os
import random
from collections import Counter

import pytest
from lakepanel.sources.files import read_quoted_csv
from lakepanel.sources.split_csv import SplitCsv, read_split_csv

PIECES = ["a", "bc", " ", ",", '""', "\n", "\n\n", "é漢", "x y", "'", "\\", ";", "0.5"]


def field(rng):
    kind = rng.random()
    if kind < 0.3:
        return rng.choice(["", "plain", " padded ", "1.5", "in\"side", "é"])
    return '"' + "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 12))) + '"'


def content(rng, records, end="\n", header="id,text,note"):
    lines = [header, *(f"{k},{field(rng)},{field(rng)}" for k in range(records))]
    if rng.random() < 0.5:
        lines.insert(rng.randint(1, len(lines)), "")
    text = end.join(lines) + (end if rng.random() < 0.7 else "")
    return text if end == "\n" else text.replace("\r\n", "\n").replace("\n", end)


def write(folder, texts):
    os.makedirs(folder, exist_ok=True)
    for k, text in enumerate(texts):
        with open(f"{folder}/f{k:02}.csv", "w", newline="", encoding="utf-8") as f:
            f.write(text)
    return f"{folder}/*.csv"


@pytest.fixture
def small_splits(spark):
    """Splits of a few dozen bytes: most records cross one, some cross many."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {n: spark.conf.get(n) for n in names}

    def cut(size):
        for n in names:
            spark.conf.set(n, str(size))

    yield cut
    for n, v in old.items():
        spark.conf.set(n, v)


def same(spark, glob):
    want = read_quoted_csv(spark, glob)
    got = read_split_csv(spark, glob)
    assert got.columns == want.columns
    rows = Counter(map(tuple, want.collect()))
    assert Counter(map(tuple, got.collect())) == rows
    return rows


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("size", [23, 61, 400, 1 << 20])
def test_equal_to_the_multi_line_reader(spark, tmp_dir, small_splits, end, size):
    rng = random.Random(size + len(end))
    glob = write(tmp_dir, [content(rng, rng.randint(20, 60), end) for _ in range(2)])
    small_splits(size)
    assert len(same(spark, glob)) > 30


def test_one_field_over_many_splits_and_odd_files(spark, tmp_dir, small_splits):
    long = 'id,text,note\n1,"' + "line\n" * 200 + '",z\n2,b,"c\n"\n'
    glob = write(tmp_dir, [long, "", "id,text,note\n", "id,text,note\n7,x,y", '\n\nid,text,note\n\n8,"q\n\n","\n"\n\n'])
    small_splits(40)
    rows = same(spark, glob)
    assert any(r[1] and r[1].count("line\n") == 200 for r in rows)
    splits = SplitCsv.open(spark, glob).splits
    assert splits.count() > 15 and splits.where("inside").count() > 5


def test_a_large_file_is_read_by_many_tasks(spark, tmp_dir, small_splits):
    rng = random.Random(1)
    glob = write(tmp_dir, [content(rng, 3000)])
    small_splits(4096)
    got = read_split_csv(spark, glob)
    assert read_quoted_csv(spark, glob).rdd.getNumPartitions() == 1
    assert got.rdd.getNumPartitions() > 8
    same(spark, glob)


def test_a_joined_state_that_is_not_broadcast_gives_the_same(spark, tmp_dir, small_splits):
    rng = random.Random(2)
    glob = write(tmp_dir, [content(rng, 200) for _ in range(3)])
    small_splits(150)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        same(spark, glob)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_headers_with_line_feeds_and_paths(spark, tmp_dir, small_splits):
    glob = write(tmp_dir, ['"i\nd",b\n1,2\n', "x,y\r\n3,4\r\n", ""])
    small_splits(5)
    opened = SplitCsv.open(spark, glob)
    assert {r["file"].rsplit("/", 1)[1]: r["header"] for r in opened.headers().collect()} == {"f00.csv": '"i\nd",b', "f01.csv": "x,y"}
    rows = opened.rows("a string, b string", "path").collect()
    assert sorted((r["a"], r["b"], r["path"].rsplit("/", 1)[1]) for r in rows) == [("1", "2", "f00.csv"), ("3", "4", "f01.csv")]


def test_a_field_that_never_ends_is_refused(spark, tmp_dir):
    glob = write(tmp_dir, ['a,b\n1,"open\n2,x\n'])
    with pytest.raises(Exception, match="does not end"):
        read_split_csv(spark, glob)
