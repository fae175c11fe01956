"""Operators 2 and 8 against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from helpers import DOCS, brute_bytes, brute_words, documents, prose, repeats_corpus
from lakepanel.llm import substring_dedup, suffix_dedup, windows
from lakepanel.llm.common import ship_package
from lakepanel.llm.suffix_array import permuted_common_prefixes, suffix_array
from lakepanel.llm.windows import BYTE_HASH, Plan, byte_units, find_runs, substring_hash, word_units


@pytest.mark.parametrize("limit", [2_000_000, 600, 1])
def test_word_repeats(spark, limit):
    """All ways of splitting: whole groups, longer prefixes, and groups beyond the limit window by window."""
    rows = repeats_corpus()
    out = substring_dedup.remove_repeats(documents(spark, rows), width=50, group_limit=limit).collect()
    got = Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in out)
    assert got == brute_words(rows, 50)
    assert sum(r["n_removed"] for r in out) > 1000


@pytest.mark.parametrize("limit", [8_000_000, 1])
def test_byte_repeats(spark, limit):
    rows = repeats_corpus(seed=12)
    out = suffix_dedup.remove_repeats(documents(spark, rows), width=400, group_limit=limit).collect()
    got = Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in out)
    assert got == brute_bytes(rows, 400)
    assert sum(r["n_removed"] for r in out) > 5000


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    assert substring_dedup.remove_repeats(none).collect() == []
    assert suffix_dedup.remove_repeats(none).collect() == []


def test_word_units_are_those_of_split():
    texts = [b" a\tbb  ccc\x0b", b"", b"x", b"\xc2\xa0 y\x1cz ", b"last"]
    raw = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0] + [len(t) for t in texts])
    units = word_units(raw, offsets)
    whole = b"".join(texts)
    got = [[whole[s:e] for s, e in zip(units.start[a:b], units.end[a:b])] for a, b in zip(units.first[:-1], units.first[1:])]
    assert got == [t.split() for t in texts]


def test_runs_cover_every_window_and_equal_windows_share_their_key():
    rng = np.random.default_rng(3)
    piece = rng.integers(97, 101, 300).astype(np.uint8)
    raw = np.concatenate([rng.integers(97, 101, 500).astype(np.uint8), piece, rng.integers(97, 101, 80).astype(np.uint8), piece])
    offsets = np.array([0, 800, 1180])
    units = byte_units(raw, offsets)
    keys = {}
    for runs in find_runs(units, 100, 16):
        for key, low, high in zip(runs.key, runs.low, runs.high):
            for w in range(low, high + 1):
                assert w not in keys
                keys[w] = key
    assert sorted(keys) == list(range(0, 701)) + list(range(800, 1081))
    same = {}
    for w, key in keys.items():
        assert same.setdefault(raw[w : w + 100].tobytes(), key) == key


def test_substring_hash_does_not_depend_on_place():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 256, 40).astype(np.uint8)
    b = np.concatenate([rng.integers(0, 256, 1000).astype(np.uint8), a])
    assert (substring_hash(BYTE_HASH[a], 20) == substring_hash(BYTE_HASH[b], 20)[1000:]).all()


def test_suffix_array_and_common_prefixes():
    rng = np.random.default_rng(2)
    for trial in range(300):
        n, k = int(rng.integers(1, 60)), int(rng.integers(1, 5))
        t = np.append(rng.integers(2, 2 + k, n), 0).astype(np.uint16)
        if trial % 3 == 0:
            t[:-1] = np.resize(t[: max(n // 5, 1)], n)
            t[t[:-1].nonzero()[0][n // 2]] = 1
        suffixes = suffix_array(t, 8)
        assert suffixes.tolist() == sorted(range(n + 1), key=lambda i: t[i:].tolist())
        ends = np.append(np.flatnonzero(t < 2), n)
        limit = ends[np.searchsorted(ends, np.arange(n + 1))] - np.arange(n + 1)
        common, before = permuted_common_prefixes(t, suffixes, limit)
        for a, b in zip(suffixes[1:], suffixes[:-1]):
            m = 0
            while m < min(limit[a], limit[b]) and t[a + m] == t[b + m]:
                m += 1
            assert (common[a], before[a]) == (m, b)


@pytest.mark.parametrize("limit", [2000, 8_000_000])
def test_a_passage_many_times_in_each_of_a_few_texts(spark, limit):
    # Few rows per anchor, but many runs.
    rng = random.Random(17)
    passage = prose(rng, 70)
    rows = [(k, "  ".join([passage, prose(rng, 5)] * 30)) for k in range(4)] + [(9, prose(rng, 200))]
    out = substring_dedup.remove_repeats(documents(spark, rows), width=50, group_limit=limit).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in out) == brute_words(rows, 50)
    out = suffix_dedup.remove_repeats(documents(spark, rows), width=400, group_limit=limit).collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in out) == brute_bytes(rows, 400)


def test_maximal_repeats_of_a_suffix_tree():
    rng = np.random.default_rng(5)
    for _ in range(300):
        texts = [rng.integers(0, rng.integers(1, 4), int(rng.integers(0, 25))).astype(np.uint64) for _ in range(int(rng.integers(1, 6)))]
        docs, width = rng.integers(0, 4, len(texts)), int(rng.integers(1, 6))
        first = np.cumsum([0] + [len(t) for t in texts])
        leaves, depth = substring_dedup.suffix_tree(np.concatenate(texts), first)
        plain = [[*map(int, t), 99 + k] for k, t in enumerate(texts)]
        suffixes = sorted(x[i:] for x in plain for i in range(len(x)))
        assert [len(x) for x in suffixes] == [int((first[1:] + np.arange(len(texts)))[np.searchsorted(first[1:] + np.arange(len(texts)), p)] - p + 1) for p in leaves]
        for a, b, d in zip(suffixes, suffixes[1:], depth[1:]):
            assert a[:d] == b[:d] and a[d : d + 1] != b[d : d + 1]
        found = [np.zeros(len(t), bool) for t in texts]
        for t, start, stop in zip(*substring_dedup.maximal_repeats(np.concatenate(texts), first, docs, width)):
            assert stop - start >= width
            found[t][start:stop] = True
        for k, t in enumerate(texts):
            smaller = {tuple(y[q : q + width]) for j, y in enumerate(texts) if docs[j] < docs[k] for q in range(len(y) - width + 1)}
            expected = np.zeros(len(t), bool)
            for p in range(len(t) - width + 1):
                if tuple(t[p : p + width]) in smaller:
                    expected[p : p + width] = True
            assert (expected == found[k]).all()


def test_groups_split_by_several_prefix_lengths(spark):
    """40 texts share 8 words, 30 of them 20, 20 of them 40, 10 of them a whole window: one group of each size."""
    rng = random.Random(23)
    common = prose(rng, 120).split()
    rows = []
    for k in range(40):
        shared = common[: 120 if k < 10 else 60 if k < 20 else 45 if k < 30 else 20]
        rows.append((k, " ".join([*prose(rng, 60).split(), *shared, *prose(rng, 60).split()])))
    rows += [(100 + k, " ".join(common[k : k + 80])) for k in range(12)]
    df = documents(spark, rows)
    base = windows.prepared(df, "doc_id", "text", null_ids=False)
    for limit in (100, 500, 1200, 2500):
        plan = Plan(word_units, 50, 8, limit)
        ship_package(spark)
        runs = substring_dedup.suffix_groups(base, windows.first_copies(base), plan).collect()
        sizes = Counter()
        for r in runs:
            sizes[r["key"]] += len(r["body"].split()) if not r["hot"] else 0
        assert max(sizes.values()) <= limit
        out = substring_dedup.remove_repeats(df, width=50, group_limit=limit).collect()
        assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in out) == brute_words(rows, 50)
