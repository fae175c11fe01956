"""Operators 6 and 7 against brute force."""

from collections import Counter

import numpy as np
from conftest_paths import SF01
from helpers import DOCS, brute_components, documents, repeats_corpus
from lakepanel.llm import hash_forest, setsketch
from lakepanel.llm.components import connected_components
from pyspark.sql import functions as F


def test_components_are_those_of_all_links(spark):
    rows = repeats_corpus(seed=13)
    frame = documents(spark, rows)
    want = brute_components(rows, 4)
    out = setsketch.near_duplicates(frame, size=4).collect()
    known = [r for r in out if r["doc_id"] is not None]
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in known) == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in known)
    assert [(r["component_id"], r["kept"]) for r in out if r["doc_id"] is None] == [(None, True)] * 2
    # Units split into pairs of blocks find the same links.
    split = setsketch.near_duplicates(frame, size=4, unit_docs=3).where("doc_id IS NOT NULL").collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in split) == want


def test_near_duplicates_of_nothing(spark):
    assert setsketch.near_duplicates(spark.createDataFrame([], DOCS)).collect() == []


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(5)
    a, b, c = (rng.integers(0, 1 << 63, n).astype(np.uint64) for n in (900, 300, 300))
    one, two = np.concatenate([a, b]), np.concatenate([a, c])
    assert (setsketch.merge(setsketch.sketch(a), setsketch.sketch(b)) == setsketch.sketch(one)).all()
    found = setsketch.estimate(setsketch.sketch(one), 1200, setsketch.sketch(two)[None, :], np.array([1200]))
    assert abs(found[0] - 900 / 1500) < 0.15


def test_connected_components(spark):
    chain = [(k, k + 1) for k in range(100, 160)]
    edges = chain + [(5, 3), (3, 9), (9, 9), (7, 7), (200, 150), (None, 3)]
    out = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    got = {r["node"]: r["component"] for r in out}
    assert got == {3: 3, 5: 3, 9: 3, 200: 100} | {k: 100 for k in range(100, 161)}


def _brute(rows, k, is_query):
    good = {i: np.array(v, float) for i, v in rows}
    for q in filter(is_query, good):
        scores = sorted(((-(good[q] * v).sum(), i) for i, v in good.items() if i != q))
        yield q, [(i, -s) for s, i in scores[:k]]


def test_nearest_finds_nine_in_ten(spark):
    table = spark.read.parquet(f"{SF01}/embeddings.parquet")
    out = hash_forest.nearest(table, F.col("vec_id") % 20 == 0).collect()
    got = {}
    for r in out:
        got.setdefault(r["query_id"], {})[r["vec_id"]] = (r["rank"], r["score"])
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    hits = total = 0
    for q, want in _brute(rows, 20, lambda i: i % 20 == 0):
        assert sorted(rank for rank, _ in got[q].values()) == list(range(1, 21))
        hits += len(got[q].keys() & {i for i, _ in want})
        total += 20
    assert hits / total >= 0.9


def test_nearest_with_odd_vectors(spark):
    good = [(0, [1.0, 0.0]), (20, [1.0, 0.0]), (3, [0.5, 0.5]), (4, [-1.0, 0.2]), (5, [3.0, 0.1]), (6, [1.0, 0.0])]
    odd = [(40, None), (60, [0.0, 0.0]), (7, [None, 1.0]), (8, [float("nan"), 1.0]), (9, [float("inf"), 1.0]), (10, [1.0]), (None, [1.0, 1.0])]
    table = spark.createDataFrame(good + odd + good[:1], "vec_id long, embedding array<float>")
    table = table.selectExpr("*", "1 AS vector", "2 AS head", "3 AS block")
    out = hash_forest.nearest(table, F.col("vec_id") % 20 == 0, k=20, trees=4).collect()
    got = {}
    for r in sorted(out, key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append((r["vec_id"], round(r["score"], 6)))
    assert got == {q: [(i, round(s, 6)) for i, s in want] for q, want in _brute(good, 20, lambda i: i % 20 == 0)}
    assert hash_forest.nearest(table.limit(0), F.lit(True)).collect() == []


def test_more_equal_vectors_than_neighbours(spark):
    rows = [(i, [1.0, 2.0]) for i in range(0, 60)] + [(100 + i, [float(i), -1.0]) for i in range(5)]
    out = hash_forest.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0, k=3, trees=4)
    got = {}
    for r in sorted(out.collect(), key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert got == {0: [1, 2, 3], 20: [0, 1, 2], 40: [0, 1, 2], 100: [0, 1, 2]} | {100: got[100]}
    assert len(got[100]) == 3
