"""The banded alignment of operator 5: against the plain table, and its work per character."""

import sys

import numpy as np

from lakepanel.llm.decontam import banded_alignment


def _fewest_edits(item, body, low, width):
    """The plain table with free ends, within the diagonals ``low`` to ``low + width - 1``."""
    big = 10**9
    held = {j: 0 for j in range(low, low + width) if 0 <= j <= len(body)}
    for i, c in enumerate(item):
        row = {}
        for j in range(low + i + 1, low + i + 1 + width):
            if not 0 <= j <= len(body):
                continue
            change = held.get(j - 1, big) + (body[j - 1] != c) if j else big
            row[j] = min(change, held.get(j, big) + 1, row.get(j - 1, big) + 1)
        held = row
    return min(held.values(), default=big)


def test_alignment_equals_the_plain_table():
    rng = np.random.default_rng(7)
    found = 0
    for _ in range(600):
        item = rng.integers(97, 100, rng.integers(1, 14)).astype(np.uint32)
        body = rng.integers(97, 100, rng.integers(0, 30)).astype(np.uint32)
        low, budget = int(rng.integers(-6, 32)), int(rng.integers(0, 5))
        width = 2 * max(budget, 1) + 1 + 2 * budget
        least = _fewest_edits(item, body, low, width)
        got = banded_alignment(item, body, low, width, budget)
        if isinstance(got, int):
            assert least > budget and 1 <= got <= len(item)
        else:
            found += 1
            assert got[0] == least and 0 <= got[1] <= got[2] <= len(body)
    assert found > 100


def test_a_character_takes_few_calls():
    item = np.tile(np.arange(97, 117, dtype=np.uint32), 10)
    calls = 0

    def count(_frame, event, _arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        found = banded_alignment(item, item, -5, 30, 12)
    finally:
        sys.setprofile(None)
    assert found == (0, 0, len(item))
    assert calls < 10 * len(item)  # 39 a character when every row was padded and clipped anew
