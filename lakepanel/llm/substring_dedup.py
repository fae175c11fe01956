"""Operator 2: substring dedup with prefix-partitioned suffix trees.

Every word that lies in a window of ``width`` consecutive words is removed if
the window's word sequence also starts in a document with a smaller id.
Windows are judged on the input texts.

The suffixes that can hold a repeat are split by a variable-length prefix: a
window belongs to the smallest hashed prefix of ``gram`` words of the suffixes
that start in it (its anchor, ``windows.py``).  Where such a group could hold
more than ``group_limit`` words, its windows are split again by prefixes of twice
the length, and so on while they are shorter than a window.  What is still too
large then is split by whole windows; such a group is one node, whose smallest
document an aggregate finds.  A task takes whole groups and builds their suffix
tree: the leaves in order (by prefix doubling) and the depth at
which neighbours part.  The maximal repeats are read off its internal nodes of
depth ``width`` or more: a leaf's repeat reaches as deep as its deepest
ancestor that also has a leaf of a smaller document, and those that the place
before does not reach as far as are the maximal ones.

Exact copies of a text are represented by the copy of smallest id; the others
lose everything if they hold a window at all.

Defined results: words are maximal runs of bytes other than space and
0x09-0x0D; a null text has none; a row with a null id neither loses words nor
makes others lose any; repeated rows of one id do not make each other lose
words; a text of any length is judged whole, in overlapping segments; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import windows
from .common import pieces, ship_package, stored, text_buffers
from .windows import ROW, Plan, Units, covered, find_runs, word_units

CHUNK_BYTES = 4 << 20
#: A stretch of a text's windows: the row and its first window.
STRETCH = [*ROW, "low"]


def suffix_tree(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffix tree of some texts as its sorted leaves and the depth of the node that parts neighbours.

    ``words`` are the texts' words one after the other, ``first`` the first word of
    each text (n + 1).  Leaves are places in the sequence with one end mark, other
    than all else, behind each text; ``depth[i]`` is that of the lowest common
    ancestor of leaves i - 1 and i.  Every internal node is an interval of leaves
    between two smaller depths.
    """
    texts = len(first) - 1
    _, name = np.unique(words, return_inverse=True)
    name = np.insert(name.astype(np.int64), first[1:], int(name.max(initial=-1)) + 1 + np.arange(texts))
    # names[k]: suffixes are equal for 2**k words if their names are, and ordered as their names.
    names, reach = [name.astype(np.int32)], 1
    while int(name.max(initial=-1)) + 1 < len(name):
        after = np.zeros(len(name), np.int64)
        after[: len(name) - reach] = name[reach:] + 1
        _, name = np.unique(name * (len(name) + 1) + after, return_inverse=True)
        name, reach = name.astype(np.int64), 2 * reach
        names.append(name.astype(np.int32))
    leaves = np.empty(len(name), np.int64)
    leaves[name] = np.arange(len(name))
    depth = np.zeros(len(name), np.int64)
    left, right = leaves[:-1], leaves[1:]
    for k in reversed(range(len(names))):
        a, b = left + depth[1:], right + depth[1:]
        inside = (a < len(name)) & (b < len(name))
        same = inside & (names[k][np.minimum(a, len(name) - 1)] == names[k][np.minimum(b, len(name) - 1)])
        depth[1:] += same.astype(np.int64) << k
    return leaves, depth


def _depth_to_smaller(docs: np.ndarray, depth: np.ndarray, longest: int) -> np.ndarray:
    """Depth of the node that each leaf shares with the nearest leaf before it of a smaller document (else 0)."""
    n, at = len(docs), np.arange(len(docs))
    least, shallow = [docs], [depth]  # over the 2**k leaves, or steps, that end here
    while (1 << len(least)) <= min(longest, n):
        half, d, s = 1 << (len(least) - 1), least[-1].copy(), shallow[-1].copy()
        d[half:] = np.minimum(d[half:], least[-1][:-half])
        s[half:] = np.minimum(s[half:], shallow[-1][:-half])
        least.append(d)
        shallow.append(s)
    found = np.full(n, np.iinfo(np.int64).max)
    for k in reversed(range(len(least))):
        before = np.maximum(at - 1, 0)
        go = (at >= 1 << k) & (least[k][before] >= docs)
        found = np.where(go, np.minimum(found, shallow[k][at]), found)
        at = np.where(go, at - (1 << k), at)
    good = (at > 0) & (docs[np.maximum(at - 1, 0)] < docs)
    return np.where(good, np.minimum(found, depth[at]), 0)


def maximal_repeats(words: np.ndarray, first: np.ndarray, docs: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``text, start, stop``: the maximal spans of ``width`` words or more that occur in a text of smaller document.

    A leaf's longest such span is as long as its deepest ancestor with a leaf of a
    smaller document is deep: the nearest such leaf on either side is below it.
    Only internal nodes of depth ``width`` or more are looked at.
    """
    leaves, depth = suffix_tree(words, first)
    deep = depth >= width
    held = deep.copy()
    held[:-1] |= deep[1:]
    held = np.flatnonzero(held)
    none = np.empty(0, np.int64)
    if not len(held):
        return none, none, none
    ends = first[1:] + np.arange(len(first) - 1)  # the end marks' places
    place, depth = leaves[held], depth[held]
    text = np.searchsorted(ends, place)
    begin = np.flatnonzero(depth < width)  # the first leaf of each deep subtree
    longest = int(np.diff(np.append(begin, len(held))).max())
    own = docs[text]
    back = np.append(0, depth[1:][::-1])
    reach = np.maximum(_depth_to_smaller(own, depth, longest), _depth_to_smaller(own[::-1], back, longest)[::-1])
    keep = np.flatnonzero(reach >= width)
    order = keep[np.argsort(place[keep])]
    place, text, stop = place[order], text[order], place[order] + reach[order]
    # Left-maximal ones only: the place before does not reach as far.
    new = np.ones(len(place), bool)
    new[1:] = (place[1:] != place[:-1] + 1) | (stop[1:] > stop[:-1])
    place, text, stop = place[new], text[new], stop[new]
    shift = first[text] + text
    return text, place - shift, stop - shift


def repeated_in_groups(table: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans (row, first word, last word + 1, relative to the run) that also start in smaller documents."""
    bodies = table.column("body").combine_chunks()
    docs = np.asarray(table.column("doc_id"))
    # Equal runs share their leaves: one body each, with its smallest document.
    encoded = bodies.dictionary_encode()
    if isinstance(encoded, pa.ChunkedArray):
        encoded = encoded.combine_chunks()
    body_of = np.asarray(encoded.indices)
    n_bodies = len(encoded.dictionary)
    smallest = np.full(n_bodies, np.iinfo(np.int64).max)
    np.minimum.at(smallest, body_of, docs)
    raw, offsets, _ = text_buffers(encoded.dictionary.cast(pa.string()))
    units = word_units(raw, offsets)
    body, start, stop = maximal_repeats(units.hash, units.first, smallest, width)
    # Rows of the smallest document have the body's spans, all others the whole body.
    rows = np.flatnonzero(docs == smallest[body_of])
    begin = np.searchsorted(body, np.arange(n_bodies + 1))
    count = np.diff(begin)[body_of[rows]]
    at = np.repeat(begin[body_of[rows]] - np.cumsum(count) + count, count) + np.arange(count.sum())
    whole = np.flatnonzero(docs > smallest[body_of])
    return (
        np.concatenate([np.repeat(rows, count), whole]),
        np.concatenate([start[at], np.zeros(len(whole), np.int64)]),
        np.concatenate([stop[at], np.diff(units.first)[body_of[whole]]]),
    )


def _anchors(texts: DataFrame, plan: Plan) -> DataFrame:
    """``key, content, doc_id, low, size``: ``windows.anchors`` of stretches of texts, which start at window ``low``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", 2 << 20):
                raw, offsets, _ = text_buffers(part.column(1))
                for found in find_runs(word_units(raw, offsets), plan.width, plan.gram):
                    of = [part.column(c).take(pa.array(found.text)) for c in (2, 0, 3)]
                    size = pa.array(found.high - found.low + plan.width, pa.int64())
                    yield pa.record_batch([pa.array(found.key.view(np.int64)), *of, size], ["key", "content", "doc_id", "low", "size"])

    rows = texts.select("doc_id", "text", "content", "low").mapInArrow(
        run, "key bigint, content bigint, doc_id bigint, low bigint, size bigint"
    )
    return rows.groupBy("key", *STRETCH).agg(F.sum("size").alias("size"))


def _cut(texts: DataFrame, plan: Plan, last: bool) -> DataFrame:
    """Runs of the ``cold`` keys of each text, and what the ``hot`` ones are split into.

    ``again`` marks the stretches of windows with hot keys, whole; at the ``last``
    prefix length those are one row per window instead, as in ``windows.runs``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", 2 << 20):
                raw, offsets, _ = text_buffers(part.column(1))
                units = word_units(raw, offsets)
                ids = tuple(np.asarray(part.column(c)) for c in (0, 2, 3))
                cold, hot = ([np.sort(np.array(s, np.int64)) for s in part.column(c).to_pylist()] for c in (4, 5))
                sets = [cold, hot if last else [np.empty(0, np.int64)] * len(hot)]
                for rows in windows.emit(plan, raw, units, ids, sets, find_runs(units, plan.width, plan.gram)):
                    yield rows.append_column("again", pa.array(np.zeros(rows.num_rows, bool)))
                if not last and any(map(len, hot)):
                    yield from _stretches(plan, raw, units, ids, hot)

    return texts.select("doc_id", "text", "content", "low", "cold", "hot").mapInArrow(
        run, "hot boolean, key bigint, key2 bigint, doc_id bigint, content bigint, low bigint, body binary, again boolean"
    )


def _stretches(plan: Plan, raw: np.ndarray, units: Units, ids: tuple, sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """The longest stretches of windows whose keys are all in their text's set."""
    edge = np.zeros(len(units.hash) + 1, np.int64)
    for found in find_runs(units, plan.width, plan.gram):
        inside = windows.member(found.key.view(np.int64), found.text, sets)
        np.add.at(edge, found.low[inside], 1)
        np.add.at(edge, found.high[inside] + 1, -1)
    window = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
    if not len(window):
        return
    text = np.searchsorted(units.first, window, side="right") - 1
    new = np.append(True, (window[1:] != window[:-1] + 1) | (text[1:] != text[:-1]))
    low, high, text = window[new], window[np.append(new[1:], True)], text[new]
    bytes_ = raw.tobytes()
    bodies = [bytes_[a:b] for a, b in zip(units.start[low].tolist(), units.end[high + plan.width - 1].tolist(), strict=True)]
    n = len(low)
    yield pa.record_batch(
        [
            pa.array(np.zeros(n, bool)),
            pa.nulls(n, pa.int64()),
            pa.nulls(n, pa.int64()),
            pa.array(ids[0][text]),
            pa.array(ids[1][text]),
            pa.array(ids[2][text] + low - units.first[text]),
            pa.array(bodies, pa.binary()),
            pa.array(np.ones(n, bool)),
        ],
        ["hot", "key", "key2", "doc_id", "content", "low", "body", "again"],
    )


def suffix_groups(docs: DataFrame, copies: DataFrame, plan: Plan) -> DataFrame:
    """The runs of ``windows.runs``, with groups beyond the limit split by longer and longer prefixes."""
    whole = windows.known(docs).withColumn("low", F.lit(0).cast("long"))
    later = copies.where("doc_id <> first_id").select(*ROW)
    texts, length, done = whole, plan.gram, []
    while True:
        now, last = replace(plan, gram=length), 2 * length >= plan.width
        if done:
            found = _anchors(texts, now)
        else:
            found = windows.anchors(texts, now).withColumn("low", F.lit(0).cast("long"))
        found = stored(found, f"prefixes_{length}")
        shared = (
            found.groupBy("key")
            .agg(F.sum("size").alias("words"), (F.min("content") != F.max("content")).alias("shared"))
            .where("shared")
            .select("key", (F.col("words") > plan.group_limit).alias("large"))
        )
        own = found.select("key", *STRETCH).join(shared, "key")
        if not done:  # longer prefixes see first copies only
            own = own.join(later, ROW, "left_anti")
        keys = own.groupBy(*STRETCH).agg(
            F.collect_set(F.when(~F.col("large"), F.col("key"))).alias("cold"),
            F.collect_set(F.when(F.col("large"), F.col("key"))).alias("hot"),
        )  # at most one entry per window of the text
        rows = stored(_cut(texts.join(keys, STRETCH), now, last), f"runs_{length}")
        done.append(rows.where("NOT again").drop("again"))
        again = rows.where("again")
        if last or again.isEmpty():
            return reduce(DataFrame.unionByName, done)
        texts = again.select(*STRETCH, F.col("body").cast("string").alias("text"))
        length *= 2


def repeated_word_spans(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = 50,
    gram: int = 8,
    group_limit: int = 2_000_000,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(documents, spans, copies)``: spans are ``doc_id, content, start, stop`` in words of first copies."""
    ship_package(docs.sparkSession)
    plan = Plan(word_units, width, gram, group_limit)
    base = windows.prepared(docs, doc_id, text, null_ids=False)
    copies = windows.first_copies(base)
    rows = suffix_groups(base, copies, plan)
    spans = windows.group_spans(rows, CHUNK_BYTES, width, repeated_in_groups)
    hot = windows.hot_spans(rows, width, F.min("doc_id"), F.col("seen") < F.col("doc_id"))
    return base, spans.unionByName(hot), copies


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 50, **options) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text, kept_sha256`` per row of ``docs``."""
    base, spans, copies = repeated_word_spans(docs, doc_id, text, width, **options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, spans_, first = (batch.column(k) for k in range(4))
            out = []
            for key, body, own, head in zip(
                ids.to_pylist(), texts.cast(pa.large_binary()).to_pylist(), spans_.to_pylist(), first.to_pylist(), strict=True
            ):
                words = (body or b"").split()
                if head is not None and key is not None and head < key:
                    kept = [] if len(words) >= width else words
                elif own:
                    gone = covered(len(words), own)
                    kept = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                else:
                    kept = words
                joined = b" ".join(kept)
                out.append((key, len(words), len(words) - len(kept), joined, hashlib.sha256(joined).hexdigest()))
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            yield pa.record_batch(
                [
                    pa.array(columns[0], pa.int64()),
                    pa.array(columns[1], pa.int64()),
                    pa.array(columns[2], pa.int64()),
                    pa.array(columns[3], pa.binary()).cast(pa.string()),
                    pa.array(columns[4], pa.string()),
                ],
                ["doc_id", "n_words", "n_removed", "kept_text", "kept_sha256"],
            )

    return (
        windows.spans_by_document(base, spans, copies)
        .select("given_id", "text", "spans", "first_id")
        .mapInArrow(run, "doc_id bigint, n_words bigint, n_removed bigint, kept_text string, kept_sha256 string")
    )
