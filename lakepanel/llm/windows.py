"""Repeated windows: shared steps of the substring (2) and suffix-array (8) operators.

A window is ``width`` consecutive units (words or bytes) of one document.  To
decide which windows occur elsewhere, suffixes must meet in groups that fit
into memory.  The group of a window is its *anchor*: the smallest hash among
the ``gram``-unit grams inside it.  Equal windows have equal anchors, and
neighbouring windows mostly share one, so consecutive windows with the same
anchor travel as one *run*: its bytes once, not once per window.

1. ``anchors``: one narrow row per (document, anchor).
2. ``shared``: anchors that occur in one text only, and once there, end here.
3. ``runs``: documents are joined with their shared anchors and cut into runs.
4. The operator sorts the suffixes of each group and finds the repeated ones.
   Groups whose runs could have more than ``group_limit`` units are cut further: their windows are
   keyed by whole-window hashes and aggregated before the shuffle, so that no
   group has to fit into one task.
5. ``spans_by_document``: repeated spans meet their document's text again.

Documents with equal text are represented by the one of smallest id
throughout (step 2 and 3), so thousands of exact copies cost one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pieces, stored, text_buffers

SEGMENT = 1 << 17  # windows handled at once: bounds a task's arrays for texts of any length
_POSITION_BITS = 28
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


BYTE_HASH = _mix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
_BASES = (0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1)


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse powers modulo 2**64, for i < n."""
    inverse = pow(base, -1, 1 << 64)
    both = []
    for b in (base, inverse):
        p = np.full(n, b, np.uint64)
        p[0] = 1
        both.append(np.multiply.accumulate(p))
    return both[0], both[1]


_POWER_CACHE: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def prefix_sums(h: np.ndarray, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Polynomial prefix sums of ``h`` and the inverse powers to compare substrings with."""
    if which not in _POWER_CACHE or len(_POWER_CACHE[which][0]) < len(h):
        _POWER_CACHE[which] = _powers(_BASES[which], 1 << max(18, int(len(h)).bit_length()))
    power, inverse = _POWER_CACHE[which]
    sums = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * power[: len(h)], out=sums[1:])
    return sums, inverse


def substring_hash(h: np.ndarray, length: int, which: int = 0) -> np.ndarray:
    """Hash of the ``length`` units from each position on."""
    sums, inverse = prefix_sums(h, which)
    n = len(h) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    return _mix((sums[length:] - sums[:n]) * inverse[:n])


@dataclass
class Units:
    """Units of some texts: ``hash`` of each, ``first`` unit of each text (n + 1), byte ``start`` and ``end``."""

    hash: np.ndarray
    first: np.ndarray
    start: np.ndarray
    end: np.ndarray


def word_units(raw: np.ndarray, offsets: np.ndarray) -> Units:
    """Maximal runs of bytes other than 0x20 and 0x09-0x0D."""
    letter = ~((raw == 0x20) | ((raw >= 0x09) & (raw <= 0x0D)))
    before = np.zeros(len(raw), bool)
    before[1:] = letter[:-1]
    inner = offsets[(offsets > 0) & (offsets < len(raw))]
    before[inner] = False
    start = np.flatnonzero(letter & ~before)
    after = np.zeros(len(raw), bool)
    after[:-1] = letter[1:]
    after[inner - 1] = False
    end = np.flatnonzero(letter & ~after) + 1
    # Byte sums are cut into segments, so that powers stay short for long texts.
    hashes = np.empty(len(start), np.uint64)
    at = 0
    while at < len(start):
        low = int(start[at])
        stop = max(int(np.searchsorted(end, low + (1 << 18), side="right")), at + 1)
        sums, inverse = prefix_sums(BYTE_HASH[raw[low : int(end[stop - 1])]])
        a, b = start[at:stop] - low, end[at:stop] - low
        hashes[at:stop] = _mix((sums[b] - sums[a]) * inverse[a] + (b - a).astype(np.uint64))
        at = stop
    return Units(hashes, np.searchsorted(start, offsets), start, end)


def byte_units(raw: np.ndarray, offsets: np.ndarray) -> Units:
    at = np.arange(len(raw) + 1)
    return Units(raw, offsets, at[:-1], at[1:])


@dataclass
class Runs:
    """Maximal sequences of consecutive windows of one text with one anchor."""

    key: np.ndarray
    text: np.ndarray  # which text of the batch
    low: np.ndarray  # first window (unit number in the batch)
    high: np.ndarray  # last window
    anchors: np.ndarray  # different places of the anchor


def find_runs(units: Units, width: int, gram: int) -> Iterator[Runs]:
    """The runs of all texts, by segments of at most ``SEGMENT`` windows."""
    total = int(units.first[-1])
    places = width - gram + 1
    at = 0
    while at + width <= total:
        stop = min(at + SEGMENT, total - width + 1)  # windows [at, stop)
        h = units.hash[at : stop + width - 1]
        h = BYTE_HASH[h] if h.dtype == np.uint8 else h
        grams = substring_hash(h, gram)
        low_bits = _U((1 << _POSITION_BITS) - 1)
        packed = (grams & ~low_bits) | np.arange(len(grams), dtype=np.uint64)
        least, reach = packed, 1
        while 2 * reach <= places:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if reach < places:
            least = np.minimum(least[: len(least) - (places - reach)], least[places - reach :])
        where = (least & low_bits).astype(np.int64)
        key = grams[where]
        window = np.arange(at, stop)
        text = np.searchsorted(units.first, window, side="right") - 1
        good = window + width <= units.first[text + 1]
        window, text, key, where = window[good], text[good], key[good], where[good]
        if len(window):
            new = np.ones(len(window), bool)
            new[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1]) | (window[1:] != window[:-1] + 1)
            begin = np.flatnonzero(new)
            last = np.append(begin[1:], len(window)) - 1
            moved = np.zeros(len(window), np.int64)
            moved[1:] = where[1:] != where[:-1]
            moves = np.cumsum(moved)
            yield Runs(key[begin], text[begin], window[begin], window[last], 1 + moves[last] - moves[begin])
        at = stop


@dataclass(frozen=True)
class Plan:
    """What a repeat search is made of; ``cut`` gives the units of a batch's texts."""

    cut: object
    width: int
    gram: int
    group_limit: int


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


def anchors(docs: DataFrame, plan: Plan) -> DataFrame:
    """``key, content, doc_id, n, size`` per document and anchor; ``docs`` has doc_id, text, content.

    ``n``: different places of the anchor; ``size``: units of its runs, whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", 2 << 20):
                raw, offsets, _ = text_buffers(part.column(1))
                units = plan.cut(raw, offsets)
                for found in find_runs(units, plan.width, plan.gram):
                    order = np.lexsort((found.key, found.text))
                    key, text = found.key[order], found.text[order]
                    new = np.ones(len(key), bool)
                    new[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1])
                    begin = np.flatnonzero(new)
                    rows = pa.array(text[begin])
                    yield pa.record_batch(
                        [
                            _signed(key[begin]),
                            part.column(2).take(rows),
                            part.column(0).take(rows),
                            pa.array(np.add.reduceat(found.anchors[order], begin), pa.int64()),
                            pa.array(np.add.reduceat((found.high - found.low + plan.width)[order], begin), pa.int64()),
                        ],
                        ["key", "content", "doc_id", "n", "size"],
                    )

    return docs.select("doc_id", "text", "content").mapInArrow(run, "key bigint, content bigint, doc_id bigint, n bigint, size bigint")


#: A row is known by its id and its content: ids may repeat.
ROW = ["doc_id", "content"]


def prepared(docs: DataFrame, doc_id: str, text: str, null_ids: bool) -> DataFrame:
    """``given_id, doc_id, text, content``; with ``null_ids``, rows without an id take part under one stand-in."""
    given = F.col(doc_id).cast("long")
    own = F.coalesce(given, F.lit(-(1 << 63))) if null_ids else given
    return docs.select(given.alias("given_id"), own.alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("content"))


def known(base: DataFrame) -> DataFrame:
    return base.where("doc_id IS NOT NULL AND text IS NOT NULL")


def first_copies(base: DataFrame) -> DataFrame:
    """``doc_id, content, first_id, copies`` of the rows whose text occurs more than once."""
    keyed = known(base).select(*ROW, F.xxhash64(F.lit(1), "text").alias("content_2"), F.octet_length("text").alias("size"))
    key = ["content", "content_2", "size"]
    groups = keyed.groupBy(*key).agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies"))
    return keyed.join(groups.where("copies > 1"), key).groupBy(*ROW).agg(
        F.first("first_id").alias("first_id"), F.first("copies").alias("copies")
    )


def runs(docs: DataFrame, copies: DataFrame, plan: Plan, own_repeats: bool) -> DataFrame:
    """The runs that share an anchor with another text (or, with ``own_repeats``, inside theirs).

    ``hot, key, key2, doc_id, content, low, body``: a run's bytes; of groups beyond the
    limit one row per window, with the window's two hashes and no bytes.
    Only the first document of equal texts is cut.
    """
    docs = known(docs)
    found = stored(anchors(docs, plan), "anchors")
    other = F.min("content") != F.max("content")
    shared = (
        found.groupBy("key")
        .agg(F.sum("size").alias("units"), (other | (F.max("n") > 1) if own_repeats else other).alias("shared"))
        .where("shared")
        .select("key", (F.col("units") > plan.group_limit).alias("hot"))
    )
    wanted = (
        found.select("key", *ROW)
        .join(shared, "key")
        .join(copies.where("doc_id <> first_id").select(*ROW), ROW, "left_anti")
        .groupBy(*ROW)
        .agg(
            F.collect_set(F.when(~F.col("hot"), F.col("key"))).alias("keys"),
            F.collect_set(F.when(F.col("hot"), F.col("key"))).alias("hot_keys"),
        )  # at most one entry per window of the document
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", 2 << 20):
                raw, offsets, _ = text_buffers(part.column(1))
                units = plan.cut(raw, offsets)
                ids = np.asarray(part.column(0)), np.asarray(part.column(4)), np.zeros(part.num_rows, np.int64)
                sets = [[np.sort(np.array(s, np.int64)) for s in part.column(c).to_pylist()] for c in (2, 3)]
                yield from emit(plan, raw, units, ids, sets, find_runs(units, plan.width, plan.gram))

    return docs.select(*ROW, "text").join(wanted, ROW).select("doc_id", "text", "keys", "hot_keys", "content").mapInArrow(
        run, "hot boolean, key bigint, key2 bigint, doc_id bigint, content bigint, low bigint, body binary"
    )


def member(keys: np.ndarray, text: np.ndarray, sets: list[np.ndarray]) -> np.ndarray:
    """Is each key in the sorted set of its text?"""
    out = np.zeros(len(keys), bool)
    edges = np.searchsorted(text, np.arange(len(sets) + 1))
    for t, own in enumerate(sets):
        a, b = edges[t], edges[t + 1]
        if b > a and len(own):
            at = np.minimum(np.searchsorted(own, keys[a:b]), len(own) - 1)
            out[a:b] = own[at] == keys[a:b]
    return out


_RUN_COLUMNS = ["hot", "key", "key2", "doc_id", "content", "low", "body"]


def emit(plan: Plan, raw: np.ndarray, units: Units, ids: tuple, sets: list, found_runs: Iterator[Runs]) -> Iterator[pa.RecordBatch]:
    """Rows of the runs with keys in ``sets`` (cold, hot); ``ids``: per text its id, content and first window."""
    bytes_ = raw.tobytes()
    for found in found_runs:
        key = found.key.view(np.int64)
        for hot in (False, True):
            keep = np.flatnonzero(member(key, found.text, sets[hot]))
            if not len(keep):
                continue
            text, low, high = found.text[keep], found.low[keep], found.high[keep]
            if not hot:
                starts, ends = units.start[low].tolist(), units.end[high + plan.width - 1].tolist()
                yield pa.record_batch(
                    [
                        pa.array(np.zeros(len(keep), bool)),
                        pa.array(key[keep]),
                        pa.array(key[keep]),
                        pa.array(ids[0][text]),
                        pa.array(ids[1][text]),
                        pa.array(ids[2][text] + low - units.first[text]),
                        pa.array([bytes_[a:b] for a, b in zip(starts, ends, strict=True)], pa.binary()),
                    ],
                    _RUN_COLUMNS,
                )
                continue
            counts = high - low + 1
            window = np.repeat(low - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
            base = int(window.min())
            h = units.hash[base : int(window.max()) + plan.width]
            h = BYTE_HASH[h] if h.dtype == np.uint8 else h
            text = np.repeat(text, counts)
            yield pa.record_batch(
                [
                    pa.array(np.ones(len(window), bool)),
                    _signed(substring_hash(h, plan.width, 0)[window - base]),
                    _signed(substring_hash(h, plan.width, 1)[window - base]),
                    pa.array(ids[0][text]),
                    pa.array(ids[1][text]),
                    pa.array(ids[2][text] + window - units.first[text]),
                    pa.nulls(len(window), pa.binary()),
                ],
                _RUN_COLUMNS,
            )


def grouped(run_rows: DataFrame, chunk_bytes: int) -> tuple[DataFrame, object]:
    """Runs with equal anchors side by side, and an iterator of chunks of whole groups."""

    def pieces_of(table: pa.Table) -> Iterator[pa.Table]:
        """Whole groups, together up to ``chunk_bytes``; a larger group is a piece of its own."""
        keys = np.asarray(table.column("key"))
        begin = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        ends = np.append(begin[1:], len(keys))
        total = np.cumsum(np.asarray(pc.binary_length(table.column("body"))))
        at = 0
        while at < len(begin):
            before = total[begin[at] - 1] if begin[at] else 0
            stop = max(int(np.searchsorted(total[ends - 1], before + chunk_bytes, side="right")), at + 1)
            yield table.slice(begin[at], ends[stop - 1] - begin[at]).combine_chunks()
            at = stop

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            keys = np.asarray(batch.column(batch.schema.get_field_index("key")))
            # The last group may go on in the next batch.
            cut = int(np.searchsorted(keys, keys[-1]))
            if cut:
                yield from pieces_of(pa.Table.from_batches([*held[:-1], batch.slice(0, cut)]))
                held = [batch.slice(cut)]
            elif len(held) > 1 and held[-2].column("key")[-1].as_py() != keys[0]:
                yield from pieces_of(pa.Table.from_batches(held[:-1]))
                held = [batch]
        if held:
            yield from pieces_of(pa.Table.from_batches(held))

    rows = run_rows.where("NOT hot").select("key", *ROW, "low", "body")
    return rows.repartition(F.col("key")).sortWithinPartitions("key"), chunks


def hot_spans(run_rows: DataFrame, width: int, agg: Column, keep: Column) -> DataFrame:
    """``doc_id, content, start, stop`` of the repeated windows of groups beyond the limit.

    ``agg`` is computed per window content with map-side combining; ``keep``
    decides from it (column ``seen``) and the window's ``doc_id``.
    """
    windows = run_rows.where("hot").select("key", "key2", *ROW, "low")
    seen = windows.groupBy("key", "key2").agg(agg.alias("seen"))
    return (
        windows.join(seen, ["key", "key2"])
        .where(keep)
        .select(*ROW, F.col("low").alias("start"), (F.col("low") + width).alias("stop"))
    )


def merge_windows(window: np.ndarray, group: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal covered spans of sorted windows: group, first unit, last unit + 1."""
    if not len(window):
        return group, window, window
    new = np.ones(len(window), bool)
    new[1:] = (group[1:] != group[:-1]) | (window[1:] > window[:-1] + width)
    begin = np.flatnonzero(new)
    last = np.append(begin[1:], len(window)) - 1
    return group[begin], window[begin], window[last] + width


def covered(n: int, spans: list[dict] | None) -> np.ndarray:
    """Which of ``n`` units the spans cover."""
    edge = np.zeros(n + 1, np.int32)
    if spans:
        np.add.at(edge, [s["start"] for s in spans], 1)
        np.add.at(edge, [s["stop"] for s in spans], -1)
    return np.cumsum(edge[:n]) > 0


def group_spans(run_rows: DataFrame, chunk_bytes: int, width: int, find) -> DataFrame:
    """``doc_id, content, start, stop`` that ``find(table, width)`` gives for chunks of whole groups."""
    dealt, chunks = grouped(run_rows, chunk_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in chunks(batches):
            row, start, stop = find(table, width)
            low, ids, content = (np.asarray(table.column(c))[row] for c in ("low", *ROW))
            yield pa.record_batch([pa.array(x) for x in (ids, content, low + start, low + stop)], [*ROW, "start", "stop"])

    return dealt.mapInArrow(run, "doc_id bigint, content bigint, start bigint, stop bigint")


def spans_by_document(base: DataFrame, spans: DataFrame, copies: DataFrame) -> DataFrame:
    """``given_id, text, spans, first_id, copies`` of every row of ``base``."""
    by_row = spans.groupBy(*ROW).agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    return base.join(by_row, ROW, "left").join(copies, ROW, "left")
