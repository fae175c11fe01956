"""Operator 13: periodic runs of words, by seed-and-extend on diagonals.

A *run* is a stretch of words with smallest period ``q`` (words ``q`` apart are
equal) of at least ``max(shortest, exponent * q)`` words that no neighbour
extends.  On the diagonal of lag ``q`` (the places ``i`` with word ``i`` equal to
word ``i + q``) it is an unbroken stretch of at least ``max(shortest, exponent *
q) - q`` places: its *guaranteed overlap*.

* **Lag classes.**  Lags ``Q .. k`` share one seed length ``k``, the minimum
  guaranteed overlap of all lags from ``Q`` on; the next class starts at
  ``k + 1``.  Classes grow threefold (at exponent 4), so there are about
  ``log3`` of a text's words of them.
* **Index.**  The k-grams of a class are named exactly (equal names, equal
  k-grams of one document): names of length ``k`` are pairs of overlapping names
  of the class before, in two steps.  Only places whose shorter grams occur
  again in the same document are named at all.
* **Occurrence pairs.**  A k-gram at least as long as the lag lies in its run
  exactly every ``q`` places (a shorter distance would be a shorter period), so
  each occurrence is paired with the next one of the document only: at most one
  pair per place and class, never all pairs.
* **Extension.**  Per lag, seeds are taken in text order.  A seed that lies
  inside what the lag's last extension has covered is dropped; any other starts
  a run.  As the next occurrence of every seed of a run is ``q`` ahead, a seed
  extends its run by one place when it directly follows the one before, and the
  covered end is that seed's end.

Texts are processed in pieces of a few megabytes; a document is one unit of
work, in memory of about 100 bytes a word.

Defined results: a null or empty text has no words, no run, and the digest of
empty strings; a text's length is not limited; equal longest runs: see
``TOP``; repeated rows give repeated results; an empty table gives an empty
result; columns other than the id and the text are ignored, whatever their
names.  ``planted`` leaves rows without an id as they are.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces, ship_package

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def TOP(run: tuple[int, int, int]) -> tuple:  # noqa: N802
    """Sort key of (start, length, period): largest exact exponent, then smallest start, then period."""
    return -Fraction(run[1], run[2]), run[0], run[2]


class _Numbers(dict):
    """Word -> its number, in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def lag_classes(longest: int, shortest: int, exponent: int) -> Iterator[tuple[int, int]]:
    """(smallest lag, seed length) of each class a text of ``longest`` words can hold a run of.

    The seed is the minimum of the guaranteed overlaps from the class's
    smallest lag on: they fall up to ``shortest / exponent`` and grow after it.
    """
    if exponent < 3:
        raise ValueError("exponent has to be 3 or more: seeds must be longer than their lags")
    low = 1
    while max(shortest, exponent * low) <= longest:
        turning = (low, max(low, shortest // exponent), max(low, -(-shortest // exponent)))
        seed = min(max(shortest, exponent * q) - q for q in turning)
        yield low, seed
        low = seed + 1


def _renamed(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Dense names of the pairs (high, low)."""
    return np.unique((high.astype(np.int64) << 32) | low, return_inverse=True)[1]


def _linked(places: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, next place of the same name), for places that have one; ``places`` ascend."""
    order = np.argsort(names, kind="stable")
    same = names[order][1:] == names[order][:-1]
    return places[order[:-1][same]], places[order[1:][same]]


class _Grams:
    """Exact names of the grams of one length, at the places where one can matter."""

    def __init__(self, words: np.ndarray):
        self.length, self.size = 1, len(words)
        self.names = words.astype(np.int64)
        self.places = np.arange(len(words))

    def lengthen(self, length: int) -> None:
        """Names of grams of ``length`` words, kept where the shorter ones occur again in the document."""
        while self.length < length and len(self.places):
            step = min(length, 2 * self.length)
            ahead = step - self.length
            order = np.argsort(self.names, kind="stable")
            same = self.names[order][1:] == self.names[order][:-1]
            again = np.zeros(len(order), bool)
            again[order[1:][same]] = True
            again[order[:-1][same]] = True
            at = np.full(self.size + 1, -1, np.int64)
            at[self.places[again]] = self.names[again]
            first = self.places[again]
            first = first[first + ahead < self.size]
            second = at[first + ahead]
            first, second = first[second >= 0], second[second >= 0]
            self.places, self.names, self.length = first, _renamed(at[first], second), step


def find_runs(words: np.ndarray, longest: int, shortest: int = 6, exponent: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of every run, by start, then period.

    ``words`` holds the word numbers of one or several documents; a number must
    not occur in two documents.  ``longest`` is the longest document's length.
    """
    out = []
    grams = _Grams(words)
    for low, seed in lag_classes(longest, shortest, exponent):
        grams.lengthen(seed)
        if not len(grams.places):
            break
        place, following = _linked(grams.places, grams.names)
        lag = following - place
        keep = (lag >= low) & (lag <= seed)
        place, lag = place[keep], lag[keep]
        if not len(place):
            continue
        order = np.lexsort((place, lag))
        place, lag = place[order], lag[order]
        # The furthest covered place of the lag ends one seed beyond its last one.
        fresh = np.ones(len(place), bool)
        fresh[1:] = (lag[1:] != lag[:-1]) | (place[1:] != place[:-1] + 1)
        first = np.flatnonzero(fresh)
        last = np.append(first[1:], len(place)) - 1
        start, period = place[first], lag[first]
        length = place[last] + seed + period - start
        whole = length >= np.maximum(shortest, exponent * period)
        out.append((start[whole], length[whole], period[whole]))
    if not out:
        return (np.empty(0, np.int64),) * 3
    start, length, period = (np.concatenate(x) for x in zip(*out, strict=True))
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def planted(doc_id: object, n: int) -> np.ndarray | None:
    """The contract's planted repetition: the original place of every word; None where nothing changes."""
    if doc_id is None or n == 0:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    place = np.arange(n)
    place[a:] = a + (place[a:] - a) % p
    return place


def _rows(ids: list, raws: list[bytes], rewrite: Callable | None, shortest: int, exponent: int) -> Iterator[tuple]:
    """(n_words, n_removed, kept words' bytes, runs) of each text."""
    texts, numbers, sizes = [], [], []
    for doc_id, raw in zip(ids, raws, strict=True):
        words = raw.split()  # the six ASCII white spaces
        place = rewrite(doc_id, len(words)) if rewrite else None
        if place is not None:
            words = [words[k] for k in place.tolist()]
        known = _Numbers()
        numbers.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
        texts.append(words)
        sizes.append(len(known))
    offsets = np.concatenate(([0], np.cumsum([len(w) for w in texts])))
    shifts = np.concatenate(([0], np.cumsum(sizes)))  # no number in two documents
    joined = np.concatenate([x + s for x, s in zip(numbers, shifts, strict=False)]) if numbers else np.empty(0, np.int64)
    start, length, period = find_runs(joined, max(map(len, texts), default=0), shortest, exponent)
    drop = np.zeros(len(joined) + 1, np.int64)
    np.add.at(drop, start + period, 1)
    np.add.at(drop, start + length, -1)
    dropped = np.cumsum(drop[:-1]) > 0
    bounds = np.searchsorted(start, offsets)
    for k, words in enumerate(texts):
        lo, hi = bounds[k], bounds[k + 1]
        runs = list(zip((start[lo:hi] - offsets[k]).tolist(), length[lo:hi].tolist(), period[lo:hi].tolist(), strict=True))
        kept = words
        n_removed = 0
        if runs:
            gone = dropped[offsets[k] : offsets[k + 1]]
            n_removed = int(gone.sum())
            kept = [words[i] for i in np.flatnonzero(~gone).tolist()]
        yield len(words), n_removed, b" ".join(kept), runs


def periodic_runs(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shortest: int = 6,
    exponent: int = 4,
    rewrite: Callable | None = None,
    keep_text: bool = True,
) -> DataFrame:
    """Every document's runs, and its text with each run cut down to its first period.

    Returns ``doc_id, n_words, n_removed, n_runs, start, length, period`` (the
    run with the greatest exponent; nulls without runs), ``exponent_milli,
    runs_sha256, collapsed_sha256``, ``runs`` (all, by start, then period) and
    ``collapsed`` (the kept words; null unless ``keep_text``).  ``rewrite`` maps
    (id, number of words) to the places of the words to take instead.
    """
    ship_package(docs.sparkSession)
    kind = docs.select(doc_id).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            for part in pieces(batch, "text"):
                ids = part.column(0).to_pylist()
                raws = [raw or b"" for raw in part.column(1).cast(pa.large_binary()).to_pylist()]
                out = list(_rows(ids, raws, rewrite, shortest, exponent))
                tops = [min(r[3], key=TOP) if r[3] else (None, None, None) for r in out]
                listed = ["".join("%d,%d,%d\n" % x for x in r[3]).encode() for r in out]
                yield pa.record_batch(
                    [
                        part.column(0),
                        pa.array([r[0] for r in out], pa.int64()),
                        pa.array([r[1] for r in out], pa.int64()),
                        pa.array([len(r[3]) for r in out], pa.int64()),
                        *(pa.array([t[k] for t in tops], pa.int64()) for k in range(3)),
                        pa.array([1000 * t[1] // t[2] if t[2] else None for t in tops], pa.int64()),
                        pa.array([hashlib.sha256(x).hexdigest() for x in listed], pa.string()),
                        pa.array([hashlib.sha256(r[2]).hexdigest() for r in out], pa.string()),
                        pa.array([[dict(zip(("start", "length", "period"), x, strict=True)) for x in r[3]] for r in out], run_type),
                        pa.array([r[2].decode() if keep_text else None for r in out], pa.string()),
                    ],
                    ["doc_id", "n_words", "n_removed", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "runs", "collapsed"],
                )

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run,
        f"doc_id {kind}, n_words bigint, n_removed bigint, n_runs bigint, start bigint, length bigint, period bigint, "
        f"exponent_milli bigint, runs_sha256 string, collapsed_sha256 string, runs {RUNS}, collapsed string",
    )
