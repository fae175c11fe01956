"""Suffix arrays of shards by induced sorting, and permuted common prefixes, in numpy.

The sequential scans of induced sorting become one step per symbol: when the
scan reaches a symbol's bucket, all suffixes that earlier buckets induce into
it are known, and those the bucket induces into itself follow from the runs of
that symbol.  Every suffix is touched once per scan, so a pass is linear.
"""

from __future__ import annotations

import numpy as np


def suffix_types(t: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than its successor (S type); the last one is."""
    n = len(t)
    differs = np.ones(n, bool)
    differs[:-1] = t[:-1] != t[1:]
    at = np.where(differs, np.arange(n, dtype=np.int32), np.int32(n))
    at = np.minimum.accumulate(at[::-1])[::-1]  # the next place where the symbol changes
    s = np.ones(n, bool)
    inner = at < n - 1
    s[inner] = t[at[inner]] < t[at[inner] + 1]
    return s


def _chains(entries: np.ndarray, length: np.ndarray) -> np.ndarray:
    """entries - 1, entries - 2, ... for ``length`` steps each: all first steps, then all second ones."""
    total = int(length.sum(dtype=np.int64))
    if not total:
        return entries[:0]
    owner = np.repeat(np.arange(len(entries)), length)
    step = np.arange(total) - np.repeat(np.cumsum(length) - length, length) + 1
    if length.max() > 1:
        order = np.argsort(step, kind="stable")
        owner, step = owner[order], step[order]
    return (entries[owner] - step).astype(np.int32)


class Inducer:
    """The two induction scans over one text whose last symbol is a unique smallest one."""

    def __init__(self, t: np.ndarray, symbols: int):
        self.t, self.symbols = t, symbols
        self.is_s = suffix_types(t)
        n = len(t)
        counts = np.bincount(t, minlength=symbols)
        self.start = np.concatenate([[0], np.cumsum(counts)])
        # Number of equal symbols directly before each place.
        change = np.ones(n, bool)
        change[1:] = t[1:] != t[:-1]
        index = np.arange(n, dtype=np.int32)  # half the memory of the default
        self.before = index - np.maximum.accumulate(np.where(change, index, 0))
        self.lms = (np.flatnonzero(self.is_s[1:] & ~self.is_s[:-1]) + 1).astype(np.int32)

    def _deal(self, entries: np.ndarray, into: list[list[np.ndarray]]) -> None:
        """Put suffixes behind each other into their symbols' buckets."""
        if not len(entries):
            return
        symbol = self.t[entries]
        order = np.argsort(symbol, kind="stable")
        entries, symbol = entries[order], symbol[order]
        cuts = np.flatnonzero(symbol[1:] != symbol[:-1]) + 1
        for part, first in zip(np.split(entries, cuts), symbol[np.concatenate([[0], cuts])], strict=True):
            into[int(first)].append(part)

    def sort(self, lms: np.ndarray) -> np.ndarray:
        """The suffix array that the LMS suffixes, in the order given, induce."""
        t, is_s, before = self.t, self.is_s, self.before
        by_symbol: list[list[np.ndarray]] = [[] for _ in range(self.symbols)]
        self._deal(lms, by_symbol)
        none = np.empty(0, np.int32)
        larger: list[list[np.ndarray]] = [[] for _ in range(self.symbols)]
        l_part: list[np.ndarray] = [none] * self.symbols
        for c in range(self.symbols):
            given = np.concatenate(larger[c]) if larger[c] else none
            if len(given):
                # A run of c before an L suffix that starts with c is L as well.
                l_part[c] = np.concatenate([given, _chains(given, before[given])])
            ready = np.concatenate([l_part[c], *by_symbol[c]])
            ready = ready[ready > 0] - 1
            self._deal(ready[(t[ready] > c) & ~is_s[ready]], larger)
        smaller: list[list[np.ndarray]] = [[] for _ in range(self.symbols)]
        s_part: list[np.ndarray] = [none] * self.symbols  # largest first
        for c in range(self.symbols - 1, -1, -1):
            given = np.concatenate(smaller[c]) if smaller[c] else none
            if c == 0:
                given = np.array([len(t) - 1], np.int32)
            if len(given):
                s_part[c] = np.concatenate([given, _chains(given, before[given])]) if c else given
            ready = np.concatenate([s_part[c], l_part[c][::-1]])
            ready = ready[ready > 0] - 1
            self._deal(ready[(t[ready] < c) & is_s[ready]], smaller)
        return np.concatenate([x for c in range(self.symbols) for x in (l_part[c], s_part[c][::-1])])


def _doubled(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a reduced text whose names repeat.

    Suffixes that share a rank are ordered by the rank ``reach`` places on;
    ``reach`` doubles, and suffixes whose rank is their own are left alone.
    """
    n = len(names)
    order = np.argsort(names)
    ranks = np.empty(n, np.int64)
    sorted_names = names[order]
    index = np.arange(n)
    new = np.ones(n, bool)
    new[1:] = sorted_names[1:] != sorted_names[:-1]
    ranks[order] = np.maximum.accumulate(np.where(new, index, 0))
    alone = new & np.append(new[1:], True)
    live, reach = order[~alone], 1
    while len(live):
        key = ranks[live] * (n + 1)
        inner = live + reach < n
        key[inner] += ranks[live[inner] + reach] + 1
        by_key = np.argsort(key)
        live, key = live[by_key], key[by_key]
        group = ranks[live]
        index = np.arange(len(live))
        new_group, new = np.ones(len(live), bool), np.ones(len(live), bool)
        new_group[1:] = group[1:] != group[:-1]
        new[1:] = key[1:] != key[:-1]
        first = np.maximum.accumulate(np.where(new_group, index, 0))
        ranks[live] = group + np.maximum.accumulate(np.where(new, index, 0)) - first
        alone = new & np.append(new[1:], True)
        live, reach = live[~alone], 2 * reach
    order[ranks] = np.arange(n)
    return order


def suffix_array(t: np.ndarray, symbols: int) -> np.ndarray:
    """Suffix array of ``t``, whose last symbol is 0 and occurs nowhere else."""
    if len(t) == 1:
        return np.zeros(1, np.int32)
    scan = Inducer(t, symbols)
    lms = scan.lms
    if len(lms) > 1:
        # Sort the LMS substrings by one induction, name them, sort the text of names.
        induced = scan.sort(lms)
        is_lms = np.zeros(len(t), bool)
        is_lms[lms] = True
        in_order = induced[is_lms[induced]]
        place = np.empty(len(t), np.int64)
        place[lms] = np.arange(len(lms))
        stop = np.append(lms[1:], len(t) - 1) + 1  # substrings include the next LMS symbol
        length = (stop - lms)[place[in_order]]
        same = np.zeros(len(lms), bool)
        check = np.flatnonzero(length[1:] == length[:-1])
        a, b, left, depth = in_order[check], in_order[check + 1], length[check], 0
        live, equal = np.arange(len(check)), np.ones(len(check), bool)
        while len(live):  # symbol by symbol, only pairs that are still equal
            ok = t[a[live] + depth] == t[b[live] + depth]
            equal[live[~ok]] = False
            depth += 1
            live = live[ok & (left[live] > depth)]
        same[check[equal] + 1] = True
        names = np.empty(len(lms), np.int64)
        names[place[in_order]] = np.cumsum(~same) - 1
        lms = lms[_doubled(names)] if same.any() else in_order
    return scan.sort(lms)


def permuted_common_prefixes(t: np.ndarray, suffixes: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """In text order: length of the common prefix with the suffix before it in the array, and that suffix.

    ``limit`` bounds each suffix (the end of its piece of text; symbols 0 and 1
    end pieces, bytes are shifted by 2).  Only the
    irreducible places, where the preceding symbols differ, are compared; the
    others follow from their left neighbour's value less one.
    """
    n = len(t)
    previous = np.full(n, -1, np.int32)
    previous[suffixes[1:]] = suffixes[:-1]
    reducible = np.zeros(n, bool)
    at = np.flatnonzero(previous[1:] > 0) + 1
    reducible[at] = (t[at - 1] == t[previous[at] - 1]) & (t[at - 1] > 1)  # not across the end of a piece
    start = np.flatnonzero(~reducible & (previous >= 0))
    packed = np.zeros(n + 8, np.uint8)
    packed[:n] = np.maximum(t, 2) - 2
    eight = np.ndarray((n + 1,), "<u8", packed.tobytes(), strides=(1,))
    room = np.minimum(limit[start], limit[previous[start]])
    length = np.zeros(len(start), np.int64)
    live = np.flatnonzero(room > 0)
    while len(live):
        a, b = start[live] + length[live], previous[start[live]] + length[live]
        apart = eight[a] ^ eight[b]
        same = apart == 0
        length[live[same]] += 8
        rest = apart[~same]
        low = rest & (~rest + np.uint64(1))
        length[live[~same]] += (np.frexp(low.astype(np.float64))[1] - 1) // 8
        live = live[same]
        live = live[length[live] < room[live]]
    common = np.zeros(n, np.int32)
    common[start] = np.minimum(length, room)
    index = np.arange(n, dtype=np.int32)
    anchor = np.maximum.accumulate(np.where(~reducible, index, 0))
    common = np.maximum(common[anchor] - (index - anchor), 0)
    common[previous < 0] = 0
    return common, previous
