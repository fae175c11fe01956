"""Operator 5: benchmark decontamination by q-gram lemma filtering.

A document is contaminated by a benchmark item if some part of it is within
the edit budget (``rate`` of the length) of the whole item, or of any
``WINDOW`` consecutive characters of a longer item.  Both are compared
lower-cased, with every run of other characters than letters and digits as one
space.

* A part within ``e`` edits of ``m`` characters shares at least
  ``m - q + 1 - q * e`` of their q-grams, on diagonals (place in the document
  less place in the item) at most ``e`` apart.
* The item places of shared q-grams are kept in bands of ``2 e + 1`` diagonals
  that overlap by ``e + 1``, so that one band holds all of a match.  In each
  band, every start of a window that holds as many places as the bound is a
  candidate; all others are discarded.
* What is left is verified by a banded alignment with free ends in the
  document.  Windows are aligned from their end: the characters after which an
  alignment is beyond the budget rule out all starts before them at once.
* Windows in budget that overlap in the document are merged.

The items' q-gram index is broadcast.  Its size is bounded: items are dealt
into blocks of about ``block_chars`` characters, and every block is searched in
all documents.  With one block, documents are not shuffled; with more, one
block's index at a time is built and broadcast, and the regions found, without
the texts, are stored and joined to the documents.

Defined results: null and empty texts have no regions; items that are null,
or have no letter or digit, take no part; items too short for ``q`` and
their budget get a smaller ``q``, and those under ``q`` characters have to occur
as they are, from word boundary to word boundary; rows that repeat an item
report it each; an empty benchmark finds nothing; regions of one item that
overlap are reported once, whole items before windows and the one with fewest
edits first; a region of windows has the edits of its worst window, and its
ends are looked for in steps of ``STEP`` characters; texts of any length are
searched whole; other columns are kept, also those named like helper columns.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import own_names, ship_package, stored
from .windows import _mix, substring_hash

FILTER_BITS = 22
WINDOW = 100
STEP = 10
REGION = "array<struct<item_id:bigint,start:bigint,stop:bigint,edits:int>>"


@lru_cache(maxsize=1)
def _wordly() -> np.ndarray:
    return np.fromiter((chr(c).isalnum() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def normalised(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points after normalisation, and the place of each in the lower-cased text."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    word = _wordly()[points]
    keep = word.copy()
    keep[1:] |= word[:-1]  # the first sign after a word stands for its run
    at = np.flatnonzero(keep)
    return np.where(word[at], points[at], np.uint32(32)), at


def _hashed(points: np.ndarray) -> np.ndarray:
    return _mix(points.astype(np.uint64) + np.uint64(1))


@dataclass
class Grams:
    """q-grams of the items that use one ``q``: sorted hashes, with the item and place of each."""

    q: int
    grams: np.ndarray
    item: np.ndarray
    place: np.ndarray
    bloom: np.ndarray


@dataclass
class Index:
    """Some items, the edit budget of each, and their q-grams by length."""

    q: int
    rate: float
    items: list[tuple[int, np.ndarray]]
    budget: np.ndarray
    size: np.ndarray
    gram: np.ndarray  # q of each item
    parts: list[Grams]


def gram_length(m: int, q: int, rate: float) -> int:
    """``q``, or the largest smaller length that keeps the bound of ``m`` characters above 0."""
    return max(1, min(q, m // (int(rate * m) + 1)))


def build_index(items: list[tuple[int, str]], q: int, rate: float) -> Index:
    kept: list[tuple[int, np.ndarray]] = []
    for item_id, text in items:
        points = normalised(text)[0] if text else np.empty(0, np.uint32)
        while len(points) and points[-1] == 32:
            points = points[:-1]
        if len(points):
            kept.append((item_id, points))
    size = np.array([len(points) for _, points in kept], np.int64)
    gram = np.array([gram_length(m, q, rate) for m in size.tolist()], np.int64)
    parts = []
    for own in np.unique(gram).tolist():
        members = np.flatnonzero(gram == own)
        found = [substring_hash(_hashed(kept[k][1]), own) for k in members]
        grams, owner = np.concatenate(found), np.repeat(members, [len(f) for f in found])
        place = np.concatenate([np.arange(len(f)) for f in found])
        order = np.argsort(grams, kind="stable")
        bloom = np.zeros(1 << FILTER_BITS, bool)
        bloom[grams >> np.uint64(64 - FILTER_BITS)] = True
        parts.append(Grams(own, grams[order], owner[order], place[order], bloom))
    return Index(q, rate, kept, np.array([int(rate * m) for m in size.tolist()], np.int64), size, gram, parts)


def banded_alignment(item: np.ndarray, body: np.ndarray, low: int, width: int, budget: int) -> tuple[int, int, int] | int:
    """Fewest edits of ``item`` against a part of ``body``, within diagonals ``low`` to ``low + width - 1``.

    Returns (edits, start, stop), or beyond the budget how many characters of
    ``item`` are enough to exceed it.  Row by row; the insertions along a row are
    one running minimum.
    """
    k = np.arange(width)
    column = low + k  # places in body at the item's first character
    big = budget + 1 + len(item)
    # The places of all rows side by side: row i looks at [i, i + width).
    places = low + np.arange(width + len(item))
    shown = np.full(len(places), 0xFFFFFFFF, np.uint32)  # unlike any character
    a, z = np.clip([-low, len(body) - low], 0, len(places)).tolist()
    shown[a:z] = body[a + low : z + low]
    outside = np.where((places >= 0) & (places < len(body)), 0, big - 1)
    beyond = places >= len(body)
    cost = np.where((column >= 0) & (column <= len(body)), 0, big)
    start, shifted, drop = column.copy(), np.zeros(width, np.int64), np.full(width, big + 1)
    least, factor = np.minimum.accumulate, width * 4
    for i, c in enumerate(item.tolist()):
        step = cost + (shown[i : i + width] != c)
        step += outside[i : i + width]
        np.add(cost[1:], 1, out=drop[:-1])
        shifted[:-1] = start[1:]
        origin = np.where(drop < step, shifted, start)
        # Running minimum that remembers its place.
        flat = least((np.minimum(step, drop) - k) * factor + k)
        start = origin[flat % factor]
        cost = flat // factor + k
        if i + width > z:
            cost[beyond[i : i + width]] = big
        if cost.min() > budget:
            return i + 1
    end = column + len(item)
    cost = np.where((end >= 0) & (end <= len(body)), cost, big)
    at = int(cost.argmin())
    if cost[at] > budget:
        return len(item)
    return int(cost[at]), int(start[at]), int(end[at])


def candidates(
    item: np.ndarray, place: np.ndarray, diagonal: np.ndarray, size: np.ndarray, budget: np.ndarray, q: int
) -> list[tuple[int, int, int, int]]:
    """``item, low, first, last``: where windows of ``size`` characters of an item share enough q-grams.

    ``low`` is the band's lowest diagonal; ``size`` and ``budget`` are per item.
    Hits that share an item and a band are looked at together.
    """
    needed = size - q + 1 - q * budget
    enough = np.bincount(item, minlength=len(size)) >= needed
    keep = enough[item]
    if not keep.any():
        return []
    item, place, diagonal = item[keep], place[keep], diagonal[keep]
    # Band b holds diagonals b * step to (b + 2) * step - 1.
    band = diagonal // np.maximum(budget, 1)[item]
    least = int(band.min()) - 1
    bands, span = int(band.max()) - least + 1, int(place.max()) + int(size.max()) + 1
    key = item * bands + band - least
    packed = np.unique(np.concatenate([key, key - 1]) * span + np.concatenate([place, place]))
    own = packed // (span * bands)
    last = np.arange(len(packed)) + needed[own] - 1
    good = last < len(packed)
    good[good] = packed[last[good]] - packed[good] <= (size[own] - q)[good]
    out: list[tuple[int, int, int, int]] = []
    for a, z, it in zip(packed[good].tolist(), packed[last[good]].tolist(), own[good].tolist(), strict=True):
        b = a // span % bands + least
        low = b * max(int(budget[it]), 1) - int(budget[it])
        first, final = max(0, z % span - int(size[it]) + q), a % span
        if out and out[-1][:2] == (it, low) and first <= out[-1][3] + 1:
            out[-1] = (it, low, out[-1][2], max(final, out[-1][3]))
        else:
            out.append((it, low, first, final))
    return out


def windows_in_budget(
    item: np.ndarray, body: np.ndarray, low: int, first: int, last: int, size: int, budget: int
) -> Iterator[tuple[int, int, int]]:
    """(edits, start, stop) of the item's windows of ``size`` characters that start from ``first`` to ``last``."""
    width = 2 * max(budget, 1) + 1 + 2 * budget
    last = min(last, len(item) - size)
    at = first
    while at <= last:
        a, z = max(0, low + at), max(0, min(len(body), low + at + size + width))
        back = z - size - (low + at) - width + 1
        found = banded_alignment(item[at : at + size][::-1], body[a:z][::-1], back, width, budget)
        if isinstance(found, int):
            at += size - found + 1
            continue
        yield found[0], z - found[2], z - found[1]
        at = min(at + STEP, last) if at < last else last + 1


def _merged(found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(edits, start, stop) with those that overlap or touch as one."""
    out: list[tuple[int, int, int]] = []
    for edits, start, stop in sorted(found, key=lambda r: r[1:]):
        if out and start <= out[-1][2]:
            out[-1] = (max(edits, out[-1][0]), out[-1][1], max(stop, out[-1][2]))
        else:
            out.append((edits, start, stop))
    return out


def regions(index: Index, text: str | None) -> list[dict]:
    """Regions of one whole text that are within an item's edit budget."""
    if not text or not index.items:
        return []
    points, places = normalised(text)
    hashed = _hashed(points)
    out: list[dict] = []
    for part in index.parts:
        if len(points) >= part.q:
            _part_regions(index, part, points, places, hashed, out)
    return sorted(out, key=lambda r: (r["start"], r["item_id"]))


def _part_regions(index: Index, part: Grams, points: np.ndarray, places: np.ndarray, hashed: np.ndarray, out: list[dict]) -> None:
    grams = substring_hash(hashed, part.q)
    maybe = np.flatnonzero(part.bloom[grams >> np.uint64(64 - FILTER_BITS)])
    left = np.searchsorted(part.grams, grams[maybe], side="left")
    count = np.searchsorted(part.grams, grams[maybe], side="right") - left
    maybe, left, count = maybe[count > 0], left[count > 0], count[count > 0]
    if not len(maybe):
        return
    at = np.repeat(left - np.cumsum(count) + count, count) + np.arange(count.sum())
    item, place, seen = part.item[at], part.place[at], np.repeat(maybe, count)
    done: dict[int, list[tuple[int, int]]] = {}

    def add(it: int, found: list[tuple[int, int, int]]) -> None:
        own = done.setdefault(it, [])
        for edits, start, stop in found:
            if all(stop <= a or start >= z for a, z in own):
                own.append((start, stop))
                out.append({"item_id": int(index.items[it][0]), "start": int(places[start]), "stop": int(places[stop - 1]) + 1, "edits": edits})

    whole: dict[int, list[tuple[int, int, int]]] = {}
    for it, low, _, _ in candidates(item, place, seen - place, index.size, index.budget, part.q):
        wanted, e = index.items[it][1], int(index.budget[it])
        a, z = max(0, low), max(0, min(len(points), low + len(wanted) + 4 * e + 3))
        found = banded_alignment(wanted, points[a:z], low - a, 2 * max(e, 1) + 1 + 2 * e, e)
        if isinstance(found, int):
            continue
        edits, start, stop = found[0], found[1] + a, found[2] + a
        ends = (start == 0 or points[start - 1] == 32) and (stop == len(points) or points[stop] == 32)
        if ends or len(wanted) >= index.q:
            whole.setdefault(it, []).append((edits, start, stop))
    for it, found in whole.items():
        add(it, sorted(found))

    # Windows of longer items, but for the hits inside a whole one.
    keep = index.size[item] > WINDOW
    for it, own in done.items():
        mine = item == it
        for a, z in own:
            keep &= ~(mine & (seen >= a) & (seen + part.q <= z))
    if not keep.any():
        return
    e = int(index.rate * WINDOW)
    size = np.full(len(index.items), WINDOW)
    windowed: dict[int, list[tuple[int, int, int]]] = {}
    for it, low, first, last in candidates(item[keep], place[keep], (seen - place)[keep], size, np.full(len(size), e), part.q):
        windowed.setdefault(it, []).extend(windows_in_budget(index.items[it][1], points, low, first, last, WINDOW, e))
    for it, found in windowed.items():
        add(it, _merged(found))


def item_blocks(benchmark: DataFrame, item_id: str, text: str, block_chars: int) -> tuple[int, Iterator[list[tuple[int, str]]]]:
    """The items in blocks of about ``block_chars`` characters, and how many; one block at a time is on the driver."""
    items = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text"))
    items = items.where("text IS NOT NULL AND item_id IS NOT NULL")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, math.ceil(total / block_chars))

    def blocks() -> Iterator[list[tuple[int, str]]]:
        for b in range(n):
            rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).orderBy("item_id", "text").collect()
            yield [(r["item_id"], r["text"]) for r in rows]

    return n, blocks()


def _finder(shared):
    @F.pandas_udf(REGION)
    def find(texts: pd.Series) -> pd.Series:
        index = shared.value
        return pd.Series([regions(index, body) for body in texts])

    return find


def with_regions(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    q: int = 12,
    rate: float = 0.06,
    item_id: str = "item_id",
    item_text: str = "text",
    block_chars: int = 1 << 22,
    into: str = "__regions",
) -> DataFrame:
    """``docs`` and the regions of each text in the column ``into`` (``item_id, start, stop, edits``).

    Places are characters of the lower-cased text.  With more than one block,
    each block's pass stores the regions it finds, under two hashes of the text,
    and its index is freed before the next one is built.
    """
    spark = docs.sparkSession
    ship_package(spark)
    n, blocks = item_blocks(benchmark, item_id, item_text, block_chars)
    if n == 1:
        shared = spark.sparkContext.broadcast(build_index(next(blocks), q, rate))
        return docs.withColumn(into, _finder(shared)(docs[text]))
    *key, back_name = own_names(docs, "__key", "__key_2", "__found")
    keyed = docs.withColumns(dict(zip(key, (F.xxhash64(docs[text]), F.xxhash64(F.lit(1), docs[text])), strict=True)))
    found = None
    for items in blocks:
        shared = spark.sparkContext.broadcast(build_index(items, q, rate))
        # Nondeterministic, so that the filter does not run it a second time.
        mine = _finder(shared).asNondeterministic()(keyed[text])
        part = stored(keyed.select(*key, mine.alias("own")).where(F.size("own") > 0), "regions")
        shared.destroy()
        part = part.groupBy(*key).agg(F.first("own").alias("own"))  # equal texts have equal regions
        found = part if found is None else found.unionByName(part)
    by_start = F.transform(F.flatten(F.collect_list("own")), lambda r: F.struct(r["start"], r["item_id"], r["stop"], r["edits"]))
    back = F.transform(F.array_sort(by_start), lambda r: F.struct(r["item_id"], r["start"], r["stop"], r["edits"])).cast(REGION)
    found = found.groupBy(*key).agg(back.alias(back_name))
    regions_ = F.coalesce(F.col(back_name), F.array().cast(REGION))
    return keyed.join(found, key, "left").withColumn(into, regions_).drop(*key, back_name)


def verdicts(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``doc_id, contaminated, n_regions, items, regions`` per row of ``docs``."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return with_regions(rows, benchmark, **options).select("doc_id", F.col("__regions").alias("regions")).select(
        "doc_id",
        (F.size("regions") > 0).alias("contaminated"),
        F.size("regions").cast("long").alias("n_regions"),
        F.array_sort(F.array_distinct(F.transform("regions", lambda r: r["item_id"]))).alias("items"),
        "regions",
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without a region, all columns kept."""
    (mark,) = own_names(docs, "__regions")
    return with_regions(docs, benchmark, text, into=mark, **options).where(F.size(mark) == 0).drop(mark)
