"""Token alignment: groups, links and counts against brute force, odd rows."""

import hashlib
import random
from collections import Counter, defaultdict
from itertools import accumulate

import public_tokenizers
import pytest
from helpers import documents, prose
from lakepanel.llm.token_align import Aligner, align_corpus, align_ends

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "  a b", "a  b", "a\n\nb", "a \n b", "\na", "a\n", " ", "\n", "a\t b", "<|endoftext|> x", "<s> </s><unk>", "it's  we'll",
    "▁a", "a ▁ b c", "漢字 かな 1234567890 $$$ \x00 \x1c \x85 \xa0x", "🙂 🙂🙂\n🙂", "x \x1cy z", "　a　b", "é" * 150,
    "a" * 3000, "\r\n a \r\n", "<0x0A> b", "tab\tbed  \t end ", "word " * 4000,
]


@pytest.fixture(scope="module")
def own():
    return Aligner(A, B)


def encoded(own, text):
    """Ids and token bytes of both, or None where they do not give the text's bytes."""
    if not text:
        return None
    a = own.a.encode(" " + text, add_special_tokens=False).ids
    b = own.b.encode(text)
    texts = [own.bytes_a[i] for i in a], [own.bytes_b[i] for i in b]
    if any(b"".join(t) != (" " + text).encode() for t in texts):
        return None
    return (a, b, *(list(accumulate(map(len, t))) for t in texts))


def brute(own, text):
    """(n_a, n_b, groups, links) by cutting at common ends and testing every pair of a group."""
    found = encoded(own, text)
    if found is None:
        return 0, 0, [], []
    a, b, ends_a, ends_b = found
    groups, links, i, j = [], [], 0, 0
    for end in sorted(set(ends_a) & set(ends_b)):
        x, y = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
        groups.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
        for p in range(i, x):
            for q in range(j, y):
                if max(([0] + ends_a)[p], ([0] + ends_b)[q]) < min(ends_a[p], ends_b[q]):
                    links.append((a[p], b[q]))
        i, j = x, y
    return len(a), len(b), groups, links


def test_alignment_of_random_ends():
    rng = random.Random(2)
    for _ in range(400):
        last = rng.randint(1, 80)
        a, b = (sorted({*rng.sample(range(1, last + 1), rng.randint(0, last)), last}) for _ in range(2))
        if rng.random() < 0.4:  # long one-to-one stretches
            b = sorted({*a[: len(a) // 2], *b[len(b) // 2 :], last})
        after_a, after_b, link_a, link_b = align_ends(a, b)
        common = sorted(set(a) & set(b))
        assert [a[k - 1] for k in after_a] == common == [b[k - 1] for k in after_b]
        pairs = [(p, q) for p in range(len(a)) for q in range(len(b)) if max(([0] + a)[p], ([0] + b)[q]) < min(a[p], b[q])]
        assert sorted(zip(link_a, link_b, strict=True)) == pairs
    assert align_ends(list(range(1, 1001)), list(range(1, 1001)))[0] == list(range(1, 1001))


def test_texts_cut_in_parts_equal_whole_texts(own):
    rng = random.Random(3)
    signs = [" ", " ", "\n", "\t", "a", "b", "the", "é", "'s", "1", "漢", "\xa0", ".", "　", "\x1c", "'"]
    texts = ODD + ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(800)]
    assert own.by_parts
    for text, (n_a, n_b, n_groups, shown, pairs) in zip(texts, own.align_all(texts), strict=True):
        a, b, groups, links = brute(own, text)
        assert (n_a, n_b, n_groups, shown) == (a, b, len(groups), ";".join(groups)), repr(text)
        assert sorted(pairs.tolist()) == sorted(x * own.size_b + y for x, y in links)


def test_whole_texts_where_the_models_give_no_cut():
    whole = Aligner(A, B)
    whole.by_parts = False
    texts = [t for t in ODD if len(t) < 1000]
    for text, (n_a, n_b, n_groups, shown, _) in zip(texts, whole.align_all(texts), strict=True):
        a, b, groups, _ = brute(whole, text)
        assert (n_a, n_b, n_groups, shown) == (a, b, len(groups), ";".join(groups)), repr(text)


@pytest.mark.parametrize("table_size", [1 << 20, 40, 0])
def test_rows_against_brute_force(spark, own, table_size):
    rng = random.Random(6)
    vocabulary = ["The", "tokenizer", "aligns", "lowercased", "words,", "Überraschung", "été", "naïve", "x=y+1;", "2024", "a", "of"]
    rows = [(k, prose(rng, rng.randint(1, 60), vocabulary)) for k in range(50)]
    rows += [(100 + k, t) for k, t in enumerate(ODD[:-1])] + [(200, ""), (201, None), (None, "The words"), rows[4], (202, ODD[-1])]
    df = documents(spark, rows).selectExpr("*", "'x' AS row", "'x' AS pairs", "'x' AS n", "'x' AS groups")
    out, counts = align_corpus(df, A, B, keep_groups=True, table_size=table_size)
    held, links = defaultdict(int), []
    for _, text in rows:
        links.append(brute(own, text))
        for pair in set(links[-1][3]):
            held[pair] += 1
    best = defaultdict(int)
    for (a, _), n in held.items():
        best[a] = max(best[a], n)
    want = Counter()
    for (doc_id, _), (n_a, n_b, groups, pairs) in zip(rows, links, strict=True):
        shown = ";".join(groups)
        digest = hashlib.sha256(shown.encode()).hexdigest() if shown else ""
        n_best = sum(held[p] == best[p[0]] for p in pairs)
        want[doc_id, n_a, n_b, len(groups), len(pairs), n_best, sum(held[p] for p in pairs), digest, shown] += 1
    cols = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"]
    assert Counter(tuple(r[c] for c in cols) for r in out.collect()) == want
    assert {(r["a"], r["b"]): r["n"] for r in counts.collect()} == held


def test_an_empty_table(spark):
    out, counts = align_corpus(documents(spark, [(1, "x")]).limit(0), A, B)
    assert out.count() == 0 and counts.count() == 0
