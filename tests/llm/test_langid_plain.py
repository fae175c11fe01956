"""Operator 3 against naive Bayes written out with dictionaries and math.log."""

import math
import random
from collections import Counter, defaultdict

import pytest
from helpers import prose
from lakepanel.llm import langid

BITS, MAX_N, SMOOTHING = 15, 3, 0.5
MASK = (1 << 32) - 1


def plain_grams(text):
    kept = []
    for ch in text.lower():
        if ch.isalpha():
            kept.append(ch)
        elif kept and kept[-1] != " ":
            kept.append(" ")
    if not kept:
        return Counter()
    points = [32, *map(ord, kept), 32]
    grams = Counter()
    for n in range(1, MAX_N + 1):
        for i in range(len(points) - n + 1):
            h = 0
            for j in range(n):
                h = (h * 0x01000193 + points[i + j] + j + 1) & MASK
            h = ((h ^ (h >> 15)) * 0x9E3779B1) & MASK
            grams[h >> (32 - BITS)] += 1
    return grams


def plain_model(rows):
    counts, docs = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        if lang is not None and text is not None:
            counts[lang] += plain_grams(text)
            docs[lang] += 1
    return counts, docs


def plain_score(model, text):
    counts, docs = model
    grams = plain_grams(text or "")
    if not grams or not docs:
        return "und", 0.0
    like = {}
    for lang in sorted(docs):
        total = sum(counts[lang].values()) + SMOOTHING * (1 << BITS)
        like[lang] = math.log(docs[lang] / sum(docs.values())) + sum(n * math.log((counts[lang][b] + SMOOTHING) / total) for b, n in grams.items())
    best = max(sorted(like), key=lambda k: like[k])
    return best, 1 / sum(math.exp(v - like[best]) for v in like.values())


def test_predictions_are_those_of_plain_naive_bayes(spark):
    rng = random.Random(41)
    alphabets = {"aa": "abcdefgh", "bb": "efghijkl", "cc": "äöüßéabc"}
    rows = []
    for k in range(90):
        lang = rng.choice(sorted(alphabets))
        words = ["".join(rng.choice(alphabets[lang]) for _ in range(rng.randrange(1, 7))) for _ in range(rng.randrange(1, 30))]
        rows.append((k, rng.choice([" ", "  ", ", ", "-7 "]).join(words), lang if k % 4 else None))
    rows += [(200, None, "aa"), (201, "", "aa"), (202, "12 %%", "bb"), (203, "İstanbul", None), (204, "aE", None), (205, "x" * 5000, None), (206, prose(rng, 400), None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = plain_model(rows)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(df, langid.fit(df)).collect()}
    for key, text, _ in rows:
        lang, score = plain_score(model, text)
        assert got[key][0] == lang, text
        assert got[key][1] == pytest.approx(score, rel=1e-9)
