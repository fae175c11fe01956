"""Small tables and brute-force versions for the operator tests."""

import hashlib
import random
import re
from collections import Counter, defaultdict

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    """A documents table of (doc_id, text) with columns whose names clash with the operators' own."""
    full = [(i, t, None if t is None else "en", f"src{(i or 0) % 3}", None if t is None else len(t)) for i, t in rows]
    df = spark.createDataFrame(full, DOCS)
    for name in ("content", "key", "copies", "spans", "kept", "n_copies", "score", "rep", "unit", "regions"):
        df = df.selectExpr("*", f"'x' AS {name}")
    return df


def prose(rng, n, vocabulary=None):
    words = vocabulary or [f"w{k}" for k in range(400)]
    return " ".join(rng.choice(words) for _ in range(n))


def repeats_corpus(seed=11):
    """Texts with exact and near copies, shared passages, repeated lines, odd cases."""
    rng = random.Random(seed)
    passage, loop = prose(rng, 90), " ".join(["tic", "tac"] * 120)
    rows = [(k, prose(rng, rng.randint(20, 160))) for k in range(40)]
    base = prose(rng, 150)
    for k in range(40, 60):
        words = base.split()
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = "edited"
        rows.append((k, " ".join(words)))
    for k in range(60, 70):
        rows.append((k, prose(rng, 30) + "\n" + passage + "  " + prose(rng, 25)))
    rows += [(70, base), (71, base), (72, loop), (73, prose(rng, 10) + " " + loop), (74, ""), (75, None), (76, "one"), (77, " \t\n")]
    rows += [(78, passage + " " + passage), (None, base), (None, prose(rng, 70)), (79, prose(rng, 3000)), (80, "é " * 260), (81, "é " * 300)]
    rows += [rows[3]]  # a repeated row
    rng.shuffle(rows)
    return rows


def brute_words(rows, width):
    """(n_words, n_removed, sha256) per (doc_id, text)."""
    first = {}
    cut = [(i, (t or "").encode().split()) for i, t in rows]
    for i, words in cut:
        if i is not None:
            for k in range(len(words) - width + 1):
                key = tuple(words[k : k + width])
                first[key] = min(i, first.get(key, i))
    out = Counter()
    for (i, words), (_, text) in zip(cut, rows, strict=True):
        gone = [False] * len(words)
        for k in range(len(words) - width + 1):
            if i is not None and first[tuple(words[k : k + width])] < i:
                gone[k : k + width] = [True] * width
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out[i, len(words), sum(gone), hashlib.sha256(kept).hexdigest()] += 1
    return out


def brute_bytes(rows, width):
    """(n_bytes, n_removed, n_spans, sha256) per row."""
    bodies = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[k : k + width] for _, b in bodies for k in range(len(b) - width + 1))
    out = Counter()
    for i, b in bodies:
        gone = bytearray(len(b))
        for k in range(len(b) - width + 1):
            if seen[b[k : k + width]] > 1:
                gone[k : k + width] = b"\1" * width
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = len([s for s in bytes(gone).split(b"\0") if s])
        out[i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


def shingles(text, size):
    words = re.sub("[A-Z]", lambda m: m[0].lower(), text or "").encode().split()
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k : k + size]) for k in range(len(words) - size + 1))


def brute_components(rows, size, percent=80):
    """(doc_id, n_shingles, component) per row with an id."""
    sets = {i: shingles(t, size) for i, t in rows if i is not None}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    held = defaultdict(set)
    for i, s in sets.items():
        for x in s:
            held[x].add(i)
    pairs = {(a, b) for members in held.values() for a in members for b in members if a < b}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return Counter((i, len(sets[i]), find(i)) for i, _ in rows if i is not None)
