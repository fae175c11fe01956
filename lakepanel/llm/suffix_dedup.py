"""Operator 8: suffix-array dedup of repeated byte strings.

Every byte that lies in a ``width``-byte string that also starts anywhere else
(in any document, the same one included; overlaps count) is removed.  Strings
are judged on the input texts, and never cross documents.

The suffixes that can start a repeat meet in shards of whole groups
(``windows.py``).  A shard's suffix array is built by induced sorting and its
permuted common prefixes are computed (``suffix_array.py``); a suffix whose
common prefix with a neighbour in the array reaches ``width`` starts a repeat.

Equal runs in a shard, and equal texts in the corpus, are kept once with their
number; where that is over one, all their strings are repeats.

Defined results: null and empty texts have 0 bytes; a text of fewer than
``width`` bytes loses nothing; every row counts as a document of its own,
repeated rows and null ids included; a text of any length is judged whole, in
overlapping segments; an empty table gives an empty result;
other columns are ignored.  The remaining bytes may cut a character, so they
are returned as binary.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import windows
from .common import ship_package, stored, text_buffers
from .suffix_array import permuted_common_prefixes, suffix_array
from .windows import Plan, byte_units, covered, merge_windows

CHUNK_BYTES = 1 << 20


def repeated_in_shard(table: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans (row, first byte, last byte + 1, relative to the run) that start elsewhere in the shard."""
    encoded = table.column("body").combine_chunks().dictionary_encode()
    if isinstance(encoded, pa.ChunkedArray):
        encoded = encoded.combine_chunks()
    body_of = np.asarray(encoded.indices)
    n_bodies = len(encoded.dictionary)
    times = np.bincount(body_of, minlength=n_bodies)
    raw, offsets, _ = text_buffers(encoded.dictionary)
    sizes = np.diff(offsets)
    # Symbols: 0 ends the shard, 1 ends a run, bytes follow.
    begin = offsets[:-1] + np.arange(n_bodies)
    t = np.ones(len(raw) + n_bodies + 1, np.uint16)
    t[-1] = 0
    body = np.repeat(np.arange(n_bodies), sizes)
    t[np.arange(len(raw)) + body] = raw.astype(np.uint16) + 2
    limit = np.zeros(len(t), np.int64)
    limit[np.arange(len(raw)) + body] = offsets[1:][body] - np.arange(len(raw))
    common, previous = permuted_common_prefixes(t, suffix_array(t, 258), limit)
    starts = np.zeros(len(t), bool)
    deep = np.flatnonzero(common >= width)
    starts[deep] = True
    starts[previous[deep]] = True
    for b in np.flatnonzero(times > 1):
        starts[begin[b] : begin[b] + max(sizes[b] - width + 1, 0)] = True
    hit = np.flatnonzero(starts)
    owner = np.searchsorted(begin, hit, side="right") - 1
    owner, first, stop = merge_windows(hit - begin[owner], owner, width)
    # Back to the rows: every row of a body has the body's spans.
    edges = np.searchsorted(owner, np.arange(n_bodies + 1))
    count = np.diff(edges)[body_of]
    row = np.repeat(np.arange(len(body_of)), count)
    at = np.repeat(edges[body_of] - np.cumsum(count) + count, count) + np.arange(count.sum())
    return row, first[at], stop[at]


def repeated_byte_spans(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = 400,
    gram: int = 48,
    group_limit: int = 4_000_000,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(documents, spans, copies)``: spans are ``doc_id, content, start, stop`` in bytes of first copies."""
    ship_package(docs.sparkSession)
    plan = Plan(byte_units, width, gram, group_limit)
    base = windows.prepared(docs, doc_id, text, null_ids=True)
    copies = windows.first_copies(base)
    rows = stored(windows.runs(base, copies, plan, own_repeats=True), "byte_runs")
    spans = windows.group_spans(rows, CHUNK_BYTES, width, repeated_in_shard)
    hot = windows.hot_spans(rows, width, F.count("*"), F.col("seen") > 1)
    return base, spans.unionByName(hot), copies


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 400, **options) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept, kept_sha256`` per row of ``docs``."""
    base, spans, copies = repeated_byte_spans(docs, doc_id, text, width, **options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, spans_, copies_ = (batch.column(k) for k in range(4))
            out = []
            for key, body, own, n in zip(
                ids.to_pylist(), texts.cast(pa.large_binary()).to_pylist(), spans_.to_pylist(), copies_.to_pylist(), strict=True
            ):
                body = body or b""
                kept, n_spans = body, 0
                if n is not None and n > 1 and len(body) >= width:
                    kept, n_spans = b"", 1
                elif own:
                    gone = covered(len(body), own)
                    kept = np.frombuffer(body, np.uint8)[~gone].tobytes()
                    n_spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                out.append((key, len(body), len(body) - len(kept), n_spans, kept, hashlib.sha256(kept).hexdigest()))
            columns = list(zip(*out, strict=True)) if out else [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string()]
            yield pa.record_batch(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"],
            )

    return (
        windows.spans_by_document(base, spans, copies)
        .select("given_id", "text", "spans", "copies")
        .mapInArrow(run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary, kept_sha256 string")
    )
