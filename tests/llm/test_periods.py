"""Periodic runs against brute force, and odd rows."""

import hashlib
import random
import zlib
from collections import Counter
from fractions import Fraction

import pytest
from helpers import documents, prose
from lakepanel.llm import periodic_runs as P


def smallest_period(words):
    fail = [0] * len(words)
    k = 0
    for i in range(1, len(words)):
        while k and words[i] != words[k]:
            k = fail[k - 1]
        k += words[i] == words[k]
        fail[i] = k
    return len(words) - fail[-1]


def brute_runs(words, shortest=6, exponent=4):
    out = set()
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(shortest, exponent * q) and smallest_period(words[i : i + length]) == q:
                out.add((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {k for s, length, q in runs for k in range(s + q, s + length)}
    top = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(runs), *top, 1000 * top[1] // top[2] if top[1] else None, sha(listed.encode()), sha(kept))


@pytest.mark.parametrize("letters,longest", [(1, 60), (2, 120), (3, 200), (40, 300)])
def test_runs_of_random_words(letters, longest):
    import numpy as np

    rng = random.Random(letters)
    for _ in range(150):
        words = []
        while len(words) < rng.randint(0, longest):
            unit = [rng.randrange(letters) for _ in range(rng.randint(1, 30))]
            words += (unit * rng.randint(1, 8))[: rng.randint(1, 120)]
        start, length, period = P.find_runs(np.array(words, np.int64), len(words))
        assert list(zip(start.tolist(), length.tolist(), period.tolist())) == brute_runs(words)


def test_other_thresholds():
    import numpy as np

    rng = random.Random(8)
    for shortest, exponent in ((3, 3), (12, 3), (6, 5)):
        for _ in range(60):
            words = [rng.randrange(2) for _ in range(80)]
            start, length, period = P.find_runs(np.array(words, np.int64), 80, shortest, exponent)
            assert list(zip(start.tolist(), length.tolist(), period.tolist())) == brute_runs(words, shortest, exponent)


def corpus():
    rng = random.Random(5)
    planted = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 10 == 0][:60]
    rows = [(i, prose(rng, rng.randint(1, 400))) for i in planted]
    rows += [(5000 + k, prose(rng, rng.randint(0, 200))) for k in range(30)]
    loop = lambda unit, times: " ".join([unit] * times)
    rows += [(6000, loop("a", 6)), (6001, loop("a", 5)), (6002, loop("a b", 4)), (6003, loop("a b", 3) + " a"), (6004, loop("é  ü\n", 50))]
    rows += [(6005, loop(loop("x", 7) + " y", 5)), (6006, loop("a a b", 9) + " " + loop("a b", 9)), (6007, ""), (6008, None), (6009, " \t\n\x0b\x0c\r ")]
    rows += [(6010, loop("t", 7) + " s " + loop("t", 7)), (6011, "a\x1cb " * 8), (None, loop("n", 9)), rows[2], rows[3]]
    rows += [(planted[0] + 10_000_019, loop(prose(rng, 700), 5))]
    rng.shuffle(rows)
    return rows


def test_rows_against_brute_force(spark):
    rows = corpus()
    df = documents(spark, rows).selectExpr("*", "'x' AS start", "'x' AS runs", "'x' AS length")
    out = P.periodic_runs(df, rewrite=P.planted)
    cols = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = Counter(tuple(r[c] for c in cols) for r in out.collect())
    assert got == Counter(brute_row(i, t) for i, t in rows)
    assert sum(n for r, n in got.items() if r[1]) >= 40
    assert P.periodic_runs(df.limit(0)).count() == 0


def test_whole_output_without_planting(spark):
    rows = [(1, "go " * 9 + "stop"), (2, "plain words"), (3, None)]
    out = {r["doc_id"]: r for r in P.periodic_runs(documents(spark, rows)).collect()}
    assert out[1]["collapsed"] == "go stop" and out[1]["n_removed"] == 8 and out[1]["n_words"] == 10
    assert [tuple(x) for x in out[1]["runs"]] == [(0, 9, 1)]
    assert out[2]["collapsed"] == "plain words" and out[2]["runs"] == [] and out[2]["exponent_milli"] is None
    assert out[3]["collapsed"] == "" and out[3]["n_words"] == 0


def test_a_very_long_text_of_one_word():
    import numpy as np

    n = 300_000
    start, length, period = P.find_runs(np.zeros(n, np.int64), n)
    assert (start.tolist(), length.tolist(), period.tolist()) == ([0], [n], [1])
