"""Operator 7: near-duplicate documents by SetSketch registers.

Each document's distinct word shingles are summarised by ``REGISTERS``
registers: the minimum of exponential variates over the set, on a grid of
exponentially spaced steps of base ``BASE``, truncated to 16 bits.  Registers
of a union are the element-wise maxima of the registers, so sketches merge;
two registers are equal with a probability close to the Jaccard similarity.

1. Documents with equal sets are one class, represented by the smallest id.
2. ``BANDS`` bands of ``ROWS`` registers are hashed.  In a bucket, every
   representative is paired with the smallest one only; the connected
   components of these pairs are *units* that hold all possible links.
3. Each unit's sets meet once.  For the pairs of a unit that are not connected
   yet, the similarity is estimated from both sketches and both set sizes by
   maximum likelihood; pairs that may reach the threshold are verified on
   their full sets.  Units beyond ``unit_docs`` documents or
   ``unit_shingles`` shingles are split into pairs of blocks, so that no task
   holds more than two blocks; all pairs of blocks are looked at.
4. The verified links' connected components are the result.

A pair at the threshold of 0.8 shares no band with probability
(1 - 0.8**5)**40 = 1.3e-7; more similar pairs less.  The estimate's standard
error is below 0.036, and pairs are verified from 0.2 below the threshold.

Defined results: a document without words (or a null text) has an empty set
and is its own component; a null id is linked with nothing, has a null
component and is kept; repeated rows of one id and text are one document
and share their result; of a component the smallest id stays, so nothing ties;
a text of any length is sketched whole; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces, ship_package, stored, text_buffers
from .components import connected_components
from .windows import _mix, prefix_sums, substring_hash, word_units

ROWS, BANDS = 5, 40
REGISTERS = ROWS * BANDS
BASE, RATE, TOP = 1.001, 20.0, (1 << 16) - 1
MARGIN = 0.2
_SEED = np.random.default_rng(20_240_607)
_FACTOR = _SEED.integers(0, 1 << 32, REGISTERS, dtype=np.uint32) | np.uint32(1)
_OFFSET = _SEED.integers(0, 1 << 32, REGISTERS, dtype=np.uint32)
_COLUMNS = 1 << 11


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a shorter text is one shingle."""
    upper = (raw >= 65) & (raw <= 90)
    units = word_units(raw + upper.astype(np.uint8) * np.uint8(32), offsets)
    full = substring_hash(units.hash, size)
    sums, inverse = prefix_sums(units.hash)
    out = []
    for a, b in zip(units.first[:-1].tolist(), units.first[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(full[a : b - size + 1]))
        elif b > a:
            whole = (sums[b : b + 1] - sums[a : a + 1]) * inverse[a : a + 1]
            out.append(_mix(whole + np.uint64(b - a)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def sketch(values: np.ndarray) -> np.ndarray:
    """The registers of a non-empty set of hashes."""
    low = (values >> np.uint64(32)).astype(np.uint32)
    least = np.full(REGISTERS, 0xFFFFFFFF, np.uint32)
    for a in range(0, len(low), _COLUMNS):
        table = np.multiply.outer(_FACTOR, low[a : a + _COLUMNS])
        table += _OFFSET[:, None]
        np.minimum(least, table.min(axis=1), out=least)
    variate = -np.log1p(-(least + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1.0 - np.log(variate) / np.log(BASE)), 0, TOP).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union of two sketched sets."""
    return np.maximum(a, b)


def band_hashes(registers: np.ndarray) -> np.ndarray:
    """One hash per band (and band number) for sketches in rows."""
    bands = registers.reshape(-1, BANDS, ROWS).astype(np.uint64)
    h = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), bands.shape[:2])
    for k in range(ROWS):
        h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + bands[:, :, k])
    return h


_GRID = np.linspace(0.0, 1.0, 101)


def estimate(own: np.ndarray, own_size: int, others: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Jaccard similarity of one set with others, most likely given both sketches and sizes.

    Of independent registers, the counts of smaller, larger and equal ones are
    multinomial with probabilities known for each similarity; the largest
    likelihood on a grid is taken.
    """
    less = (others < own).sum(axis=1)[:, None]
    more = (others > own).sum(axis=1)[:, None]
    same = others.shape[1] - less - more
    u = (own_size / (own_size + sizes))[:, None]
    v = 1.0 - u
    j = np.minimum(_GRID[None, :], np.minimum(u / v, v / u))

    def above(x: np.ndarray) -> np.ndarray:
        return np.clip(-np.log1p(-np.clip(x, 0.0, 1.0) * (BASE - 1.0) / BASE) / np.log(BASE), 1e-12, 1.0)

    own_more, other_more = above(u - v * j), above(v - u * j)
    equal = np.clip(1.0 - own_more - other_more, 1e-12, 1.0)
    likelihood = less * np.log(own_more) + more * np.log(other_more) + same * np.log(equal)
    return np.take_along_axis(j, likelihood.argmax(axis=1)[:, None], axis=1)[:, 0]


def link_unit(ids: np.ndarray, block: np.ndarray, sets: list[np.ndarray], registers: np.ndarray, percent: int) -> np.ndarray:
    """Component number of each document of a unit (or of a pair of blocks)."""
    n = len(ids)
    comp = np.arange(n)
    sizes = np.array([len(s) for s in sets])
    split = len(np.unique(block)) > 1
    for i in range(n - 1):
        j = np.arange(i + 1, n)
        ok = comp[i + 1 :] != comp[i]
        ok &= 100 * np.minimum(sizes[i], sizes[i + 1 :]) >= percent * np.maximum(sizes[i], sizes[i + 1 :])
        if split:  # pairs inside a block are another task's
            ok &= block[i + 1 :] != block[i]
        j = j[ok]
        if not len(j):
            continue
        # Half the registers equal is ten standard errors below the threshold.
        j = j[2 * (registers[j] == registers[i]).sum(axis=1) >= REGISTERS]
        if not len(j):
            continue
        likely = estimate(registers[i], sizes[i], registers[j], sizes[j])
        for k in j[likely >= percent / 100 - MARGIN]:
            if comp[k] == comp[i]:
                continue
            shared = np.intersect1d(sets[i], sets[k], assume_unique=True).size
            if 100 * shared >= percent * (sizes[i] + sizes[k] - shared):
                comp[comp == comp[k]] = comp[i]
    return comp


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id, n_shingles, set_key, registers`` per row of ``doc_id, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", 2 << 20):
                raw, offsets, _ = text_buffers(part.column(1))
                sets = shingle_sets(raw, offsets, size)
                yield pa.record_batch(
                    [
                        part.column(0),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                        pa.array([sketch(s).tobytes() if len(s) else None for s in sets], pa.binary()),
                    ],
                    ["doc_id", "n_shingles", "set_key", "registers"],
                )

    return docs.mapInArrow(run, "doc_id bigint, n_shingles bigint, set_key binary, registers binary")


def candidate_pairs(reps: DataFrame) -> DataFrame:
    """Distinct ``a, b``: each representative with the smallest one of each of its buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                regs = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, REGISTERS)
                hashes = band_hashes(regs)
                ids = np.repeat(np.asarray(batch.column(0)), BANDS)
                yield pa.record_batch([pa.array(hashes.reshape(-1).view(np.int64)), pa.array(ids)], ["bucket", "doc_id"])

    buckets = reps.select("doc_id", "registers").mapInArrow(run, "bucket bigint, doc_id bigint")
    buckets = stored(buckets, "buckets")
    heads = buckets.groupBy("bucket").agg(F.min("doc_id").alias("head"), F.max("doc_id").alias("last")).where("head <> last")
    pairs = buckets.join(heads.select("bucket", "head"), "bucket").where("doc_id <> head")
    return pairs.select(F.col("doc_id").alias("a"), F.col("head").alias("b")).distinct()


def verified_links(docs: DataFrame, units: DataFrame, size: int, percent: int, unit_docs: int, unit_shingles: int) -> DataFrame:
    """``a, b``: links between representatives; ``units`` has doc_id, unit, n_shingles, registers."""
    sizes = units.groupBy("unit").agg(
        F.greatest(F.ceil(F.count("*") / F.lit(unit_docs)), F.ceil(F.sum("n_shingles") / F.lit(unit_shingles))).alias("blocks")
    )
    # Of b blocks, every document goes to the b pairs that hold its own block.
    units = units.join(sizes, "unit").withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")))
    placed = (
        docs.join(units, "doc_id")
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select(
            F.xxhash64("unit", F.least("block", "other"), F.greatest("block", "other")).alias("place"),
            "unit",
            F.least("block", "other").alias("one"),
            F.greatest("block", "other").alias("two"),
            "doc_id",
            "block",
            "registers",
            "text",
        )
    )

    def link(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        one, two, unit = (np.asarray(table.column(c)) for c in ("one", "two", "unit"))
        raw, offsets, _ = text_buffers(table.column("text"))
        sets = shingle_sets(raw, offsets, size)
        regs = np.frombuffer(b"".join(table.column("registers").to_pylist()), np.uint16).reshape(-1, REGISTERS)
        ids, block = np.asarray(table.column("doc_id")), np.asarray(table.column("block"))
        order = np.lexsort((ids, two, one, unit))
        key = np.stack([unit[order], one[order], two[order]])
        edges = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
        for own in np.split(order, edges):
            comp = link_unit(ids[own], block[own], [sets[k] for k in own], regs[own], percent)
            head = ids[own][comp]  # a component is numbered by one of its members
            yield ids[own][ids[own] != head], head[ids[own] != head]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(b.nbytes for b in held) < 8 << 20:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            places = np.asarray(table.column("place"))
            cut = int(np.searchsorted(places, places[-1]))
            if cut:
                for a, b in link(table.slice(0, cut).combine_chunks()):
                    yield pa.record_batch([pa.array(a), pa.array(b)], ["a", "b"])
                held = table.slice(cut).to_batches()
        if held:
            for a, b in link(pa.Table.from_batches(held).combine_chunks()):
                yield pa.record_batch([pa.array(a), pa.array(b)], ["a", "b"])

    return placed.repartition(F.col("place")).sortWithinPartitions("place").mapInArrow(run, "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = 5,
    percent: int = 80,
    unit_docs: int = 4096,
    unit_shingles: int = 4_000_000,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row of ``docs``.

    Documents with ``100 * shared >= percent * union`` shingles of ``size``
    words are linked; a component keeps its smallest id.
    """
    ship_package(docs.sparkSession)
    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    signed = stored(signatures(base, size), "signatures")
    usable = signed.where("doc_id IS NOT NULL AND set_key IS NOT NULL")
    classes = usable.groupBy("set_key").agg(F.min("doc_id").alias("rep"))
    reps = stored(
        usable.join(classes, "set_key").where("doc_id = rep").dropDuplicates(["doc_id", "set_key"]).select("doc_id", "n_shingles", "registers"),
        "representatives",
    )
    units = connected_components(candidate_pairs(reps))
    units = reps.join(units.select(F.col("node").alias("doc_id"), F.col("component").alias("unit")), "doc_id")
    known = base.where("doc_id IS NOT NULL AND text IS NOT NULL")
    links = verified_links(known, units, size, percent, unit_docs, unit_shingles)
    found = connected_components(links)
    comps = classes.join(found.select(F.col("node").alias("rep"), "component"), "rep", "left")
    comps = comps.select("set_key", F.coalesce("component", "rep").alias("component"))
    return (
        signed.select("doc_id", "n_shingles", "set_key")
        .join(comps, "set_key", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
            (F.col("doc_id").isNull() | (F.coalesce("component", "doc_id") == F.col("doc_id"))).alias("kept"),
        )
    )
