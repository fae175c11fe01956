"""Operator 11: alignment of two tokenizers' tokens, and corpus-wide link counts.

Tokenizer A (byte-level BPE) encodes a space and the text, tokenizer B
(sentencepiece BPE, which adds the space itself) the text.  Both give arrays of
byte offsets where tokens end.  Offsets in both arrays cut the tokens into
groups; within a group every A-B pair of overlapping tokens is a link.

* **Diagonal run skipping** (``align_ends``).  On a one-to-one stretch the two
  end arrays are equal at a constant index shift.  Slices of 1, 2, 4, ... ends
  are compared at the current shift until they differ, then the last step is
  halved down, so a stretch is jumped in a logarithmic number of comparisons.
  Where it ends, the token whose end lies behind is advanced until both ends
  meet: an irregular group, which gives the new shift.
* **Parts.**  Before a single space, and before a line feed, that a sign
  follows, both tokenizers begin anew (A by its pre-tokenizer, B because no
  piece has a space mark behind another sign or holds a line feed), so tokens
  and groups of the parts do not depend on what surrounds them.  Parts not seen
  before are joined to one long stream, encoded with one call each and aligned
  as one pair of arrays; a bounded cache in each worker keeps the parts' groups
  and links.  ``Aligner`` checks the loaded models and aligns whole texts where
  the conditions do not hold.
* **Counts.**  A pair's count is the number of documents that hold it linked:
  documents are stored with their distinct pairs, which are counted with
  partial sums.  Pairs counted at least a threshold are looked up in a
  broadcast table of at most ``table_size`` pairs; all rarer ones (none of them
  a hot key) are joined.  The best count of each A id is an array with one entry
  per vocabulary entry.

Defined results: null and empty texts, and texts whose tokens do not give back
the text's bytes, have no tokens, zeros and empty groups; a text's length is
not limited; several pairs with an A id's best count are all best; repeated
rows count as documents of their own; null ids are kept; an empty table gives
an empty result; columns other than the id and the text are ignored, whatever
their names.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces, ship_package, stored
from .token_count import PreTokenCounter

CACHE_ENTRIES = 5 << 17
LONGEST_KEY = 64
B_PARTS = 128
_SPACE = "▁"
# A space or line feed that no sign follows: the text needs the general cut.
_LOOSE = re.compile(r"[ \n](?!\S)")
_CUT = re.compile(r"(?<! )(?= \S)|(?=\n\S)")


# ------------------------------------------------------------------- alignment
def align_ends(a: list[int], b: list[int]) -> tuple[list[int], list[int], list[int], list[int]]:
    """Groups and links of two lists of ascending end offsets with the same last end.

    Returns the token numbers (of a, of b) behind each group's last token, and
    the two lists of linked token numbers, in order.
    """
    after_a: list[int] = []
    after_b: list[int] = []
    link_a: list[int] = []
    link_b: list[int] = []
    i = j = 0
    n = len(a)
    while i < n:
        run, step = 0, 1
        while (probe := a[i + run : i + run + step]) and probe == b[j + run : j + run + step]:
            run += step
            step *= 2
        while step > 1:
            step //= 2
            if (probe := a[i + run : i + run + step]) and probe == b[j + run : j + run + step]:
                run += step
        if run > n - i:  # the last probe was shorter than its step
            run = n - i
        if run:
            after_a += range(i + 1, i + run + 1)
            after_b += range(j + 1, j + run + 1)
            link_a += range(i, i + run)
            link_b += range(j, j + run)
            i += run
            j += run
            if i == n:
                break
        while True:
            link_a.append(i)
            link_b.append(j)
            x, y = a[i], b[j]
            if x <= y:
                i += 1
            if y <= x:
                j += 1
            if x == y:
                break
        after_a.append(i)
        after_b.append(j)
    return after_a, after_b, link_a, link_b


def _byte_alphabet() -> dict[str, int]:
    """Byte-level BPE's printable stand-ins: visible Latin-1 signs stand for themselves, the rest follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(0x100 + k): b for k, b in enumerate(rest)}


class Aligner:
    """Aligns the tokens of a byte-level BPE (a tokenizers file) and a sentencepiece model."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        counter = PreTokenCounter(path_b)
        self.b = counter.sp
        alphabet = _byte_alphabet()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.size_a, self.size_b = max(vocabulary.values()) + 1, self.b.get_piece_size()
        self.bytes_a = [b""] * self.size_a
        for token, i in vocabulary.items():
            plain = all(c in alphabet for c in token)
            self.bytes_a[i] = bytes(alphabet[c] for c in token) if plain else token.encode()
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_SPACE, " ").encode()
            for i, p in ((i, self.b.id_to_piece(i)) for i in range(self.size_b))
        ]
        self.length_a, self.length_b = (np.array(list(map(len, x)), np.int64) for x in (self.bytes_a, self.bytes_b))
        self.pair_type = np.int32 if self.size_a * self.size_b < 1 << 31 else np.int64
        self.by_parts = counter.by_parts and self._cuts_before_spaces()
        self.cache: dict[str, tuple | None] = {}

    def _cuts_before_spaces(self) -> bool:
        """Whether A's pre-tokenizer is the byte-level pattern alone."""
        made = json.loads(self.a.to_str())
        pre = made.get("pre_tokenizer") or {}
        return (
            made.get("normalizer") is None
            and pre.get("type") == "ByteLevel"
            and pre.get("use_regex", True)
            and not pre.get("add_prefix_space")
            and all(t["special"] for t in made.get("added_tokens") or ())
        )

    # ------------------------------------------------------------ parts
    @staticmethod
    def cut(text: str) -> list[str]:
        """Keys of the parts of a space and the text (see ``_part``)."""
        full = " " + text
        if not _LOOSE.search(full):
            return full.replace("\n", " \n").split(" ")[1:]
        keys = []
        for part in _CUT.split(full):
            if part[:1] == " " and part[1:2].strip():
                keys.append(part[1:])
            elif part[:1] == "\n" and part[1:2].strip():
                keys.append(part)
            elif part:
                keys.append(" " + part)  # begins with white space, or with what follows none
        return keys

    @staticmethod
    def _part(key: str) -> str:
        """The text of a key: a space and the key, the key itself behind a line feed, or what follows its space."""
        return key[1:] if key[0] == " " else key if key[0] == "\n" else " " + key

    def _aligned(self, parts: list[str]) -> list[tuple | None]:
        """Groups of the parts of one stream; None for a part whose tokens do not give its bytes."""
        stream = "".join(parts)
        a_ids = self.a.encode_batch_fast([stream], add_special_tokens=False)[0].ids
        # The model's merge queue grows with its input, so it gets the stream in shorter calls.  "\n" in
        # front keeps the prefix it adds apart: the mark and the line feed are two pieces.
        calls = ["\n" + "".join(parts[k : k + B_PARTS]) for k in range(0, len(parts), B_PARTS)]
        b_ids = [i for ids in self.b.encode(calls, num_threads=1) for i in ids[2:]]
        return self._groups(a_ids, b_ids, [p.encode() for p in parts])

    def _groups(self, a_ids: list[int], b_ids: list[int], parts: list[bytes]) -> list[tuple | None]:
        whole = b"".join(parts)
        texts = [b"".join(map(table.__getitem__, ids)) for table, ids in ((self.bytes_a, a_ids), (self.bytes_b, b_ids))]
        if texts != [whole, whole]:
            if len(parts) == 1:
                return [None]
            return [x for p in parts for x in self._aligned([p.decode()])]
        a_ends, b_ends = self.length_a[a_ids].cumsum(), self.length_b[b_ids].cumsum()
        after_a, after_b, link_a, link_b = align_ends(a_ends.tolist(), b_ends.tolist())
        bounds = np.array(list(map(len, parts))).cumsum()
        group_ends = a_ends[np.array(after_a) - 1]
        to_group = np.searchsorted(group_ends, bounds) + 1
        if len(parts) > 1 and not np.array_equal(group_ends[to_group - 1], bounds):
            return [x for p in parts for x in self._aligned([p.decode()])]  # a token over a part's end
        numbers_a, numbers_b = np.array(a_ids, np.int64), np.array(b_ids, np.int64)
        pairs = (numbers_a[link_a] * self.size_b + numbers_b[link_b]).astype(self.pair_type)
        to_a, to_b = np.array(after_a)[to_group - 1], np.array(after_b)[to_group - 1]
        # m and n tokens of a group without a common end inside make m + n - 1 links.
        to_link = to_a + to_b - to_group
        text_a, text_b = list(map(str, a_ids)), list(map(str, b_ids))
        shown, i, j = [], 0, 0
        for x, y in zip(after_a, after_b, strict=True):
            if x == i + 1 and y == j + 1:
                shown.append(text_a[i] + "|" + text_b[j])
            else:
                shown.append(",".join(text_a[i:x]) + "|" + ",".join(text_b[j:y]))
            i, j = x, y
        raw, width = pairs.tobytes(), pairs.itemsize
        sizes = (np.diff(to_a, prepend=0) + (np.diff(to_b, prepend=0) << 32)).tolist()
        out, g, l = [], 0, 0  # noqa: E741
        for g2, l2, size in zip(to_group.tolist(), (to_link * width).tolist(), sizes, strict=True):
            out.append((";".join(shown[g:g2]), raw[l:l2], size))
            g, l = g2, l2  # noqa: E741
        return out

    def _learn(self, keys: list[str]) -> None:
        """Put the parts behind ``keys`` into the cache."""
        joined = [k for k in keys if k[0] != " " and not k[-1].isspace()]
        if joined:
            self.cache.update(zip(joined, self._aligned([self._part(k) for k in joined]), strict=True))
        for k in keys:
            if k[0] == " " or k[-1].isspace():
                self.cache[k] = self._aligned([self._part(k)])[0]

    def align_all(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, str, np.ndarray]]:
        """(A tokens, B tokens, groups, groups as text, linked pairs) of each text; a pair is ``a * size_b + b``."""
        cuts = [([" " + " " + t] if not self.by_parts else self.cut(t)) if t else [] for t in texts]
        new = set().union(*cuts).difference(self.cache)
        if new:
            self._learn(list(new))
        get = self.cache.__getitem__
        for text, keys in zip(texts, cuts, strict=True):
            found = list(map(get, keys))
            if None in found and len(found) > 1:
                found = self._aligned([" " + text])  # judged on the whole text's bytes
            if not found or None in found:
                yield 0, 0, 0, "", np.empty(0, self.pair_type)
                continue
            groups, links, sizes = zip(*found, strict=True)
            n, shown = sum(sizes), ";".join(groups)
            yield n & 0xFFFFFFFF, n >> 32, shown.count(";") + 1, shown, np.frombuffer(b"".join(links), self.pair_type)
        for key in new:
            if len(key) > LONGEST_KEY:
                del self.cache[key]
        if len(self.cache) > CACHE_ENTRIES:
            self.cache.clear()


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """One aligner per process: a Python worker keeps its cache from task to task."""
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


def align_documents(
    docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text", keep_groups: bool = True
) -> DataFrame:
    """Every document's alignment, without corpus-wide counts.

    Returns ``doc_id, n_a, n_b, n_groups, n_links, groups_sha256, groups`` (text
    ``a1,a2|b1;a3|b2``; null unless ``keep_groups``), ``pairs`` (distinct linked
    pairs, ``a * size of B + b``, ascending) and ``times`` (links of each).
    """
    ship_package(docs.sparkSession)
    kind = docs.select(doc_id).schema[0].dataType.simpleString()
    wide = aligner(path_a, path_b).pair_type is np.int64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(path_a, path_b)
        pair_type = pa.int64() if wide else pa.int32()
        for batch in batches:
            for part in pieces(batch, "text", 2 << 20):
                sizes, digests, shown, pairs, times = [], [], [], [], []
                for n_a, n_b, n_groups, groups, linked in own.align_all(part.column(1).to_pylist()):
                    distinct, n = np.unique(linked, return_counts=True)
                    sizes.append((n_a, n_b, n_groups, len(linked)))
                    digests.append(hashlib.sha256(groups.encode()).hexdigest() if groups else "")
                    shown.append(groups if keep_groups else None)
                    pairs.append(distinct)
                    times.append(n.astype(np.int32))
                ends = pa.array(np.concatenate(([0], np.cumsum([len(x) for x in pairs]))), pa.int32())
                yield pa.record_batch(
                    [
                        part.column(0),
                        *(pa.array([x[k] for x in sizes], pa.int64()) for k in range(4)),
                        pa.array(digests, pa.string()),
                        pa.array(shown, pa.string()),
                        pa.ListArray.from_arrays(ends, pa.array(np.concatenate(pairs), pair_type)),
                        pa.ListArray.from_arrays(ends, pa.array(np.concatenate(times), pa.int32())),
                    ],
                    ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups", "pairs", "times"],
                )

    pair_kind = "bigint" if wide else "int"
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run,
        f"doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, groups string, "
        f"pairs array<{pair_kind}>, times array<int>",
    )


# ---------------------------------------------------------------------- counts
def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """``pair, a, b, n``: in how many documents each pair is linked."""
    counted = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    a = F.floor(F.col("pair") / F.lit(size_b)).cast("bigint")
    return counted.select("pair", a.alias("a"), (F.col("pair") - a * size_b).cast("bigint").alias("b"), "n")


def _cut_off(counts: DataFrame, table_size: int) -> int:
    """Smallest power of two that at most ``table_size`` pairs are counted at least."""
    level = F.floor(F.log2(F.col("n"))).cast("int")
    rows = sorted(counts.groupBy(level.alias("level")).count().collect(), reverse=True)  # 63 rows at most
    held, least = 0, 1 << 62
    for r in rows:
        held += r["count"]
        if held > table_size:
            return least
        least = 1 << r["level"]
    return 1


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offsets, pairs and times of a batch whose last two columns are these lists."""
    pairs, times = batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)
    ends = np.asarray(pairs.offsets)
    return ends - ends[0], np.asarray(pairs.flatten()), np.asarray(times.flatten())


def with_counts(aligned: DataFrame, counts: DataFrame, size_a: int, size_b: int, table_size: int = 1 << 20) -> DataFrame:
    """``aligned`` (stored, with a unique ``row``) with ``n_best`` and ``count_sum`` in place of the pair lists."""
    spark = aligned.sparkSession
    best = np.zeros(size_a, np.int64)
    top = counts.groupBy("a").agg(F.max("n").alias("n")).toPandas()  # one row per entry of A's vocabulary at most
    best[top["a"].to_numpy(np.int64)] = top["n"].to_numpy(np.int64)
    least = _cut_off(counts, table_size)
    table = counts.where(F.col("n") >= least).select("pair", "n").toPandas().sort_values("pair")
    known = table["pair"].to_numpy(np.int64), table["n"].to_numpy(np.int64)
    shared = spark.sparkContext.broadcast((*known, best))
    plain = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups"]

    def looked_up(batch: pa.RecordBatch) -> tuple:
        pair, n, _ = shared.value
        ends, values, times = _flat(batch)
        if not len(pair):
            return ends, values, times, np.zeros(len(values), np.int64)
        at = np.minimum(np.searchsorted(pair, values), len(pair) - 1)
        return ends, values, times, np.where(pair[at] == values, n[at], 0)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends, values, times, n = looked_up(batch)
            is_best = (n > 0) & (n == shared.value[2][values // size_b])
            totals = [np.diff(np.concatenate(([0], np.cumsum(x)))[ends]) for x in (np.where(is_best, times, 0), times * n)]
            columns = [batch.column(k) for k in range(len(plain))]
            yield pa.record_batch([*columns, *(pa.array(t, pa.int64()) for t in totals)], [*plain, "n_best", "count_sum"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in aligned.select(*plain).schema)
    rows = aligned.select(*plain, "pairs", "times").mapInArrow(sums, f"{kinds}, n_best bigint, count_sum bigint")
    if least == 1:
        return rows

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends, values, times, n = looked_up(batch)
            missed = n == 0
            row = np.repeat(np.asarray(batch.column(0)), np.diff(ends))
            yield pa.record_batch(
                [pa.array(row[missed], pa.int64()), pa.array(values[missed], pa.int64()), pa.array(times[missed], pa.int64())],
                ["row", "pair", "times"],
            )

    # Pairs counted fewer than ``least`` times: joined, each to at most so many rows.
    tops = counts.groupBy("a").agg(F.max("n").alias("best"))
    rest = counts.where(F.col("n") < least).join(tops, "a").select(F.col("pair").cast("bigint").alias("pair"), "n", "best")
    more = (
        aligned.select("row", "pairs", "times")
        .mapInArrow(rare, "row bigint, pair bigint, times bigint")
        .join(rest, "pair")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("n") == F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
            F.sum(F.col("times") * F.col("n")).alias("more_count"),
        )
    )
    return rows.join(more, "row", "left").select(
        *plain,
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_count", F.lit(0))).alias("count_sum"),
    )


def align_corpus(
    docs: DataFrame,
    path_a: str,
    path_b: str,
    doc_id: str = "doc_id",
    text: str = "text",
    keep_groups: bool = False,
    table_size: int = 1 << 20,
) -> tuple[DataFrame, DataFrame]:
    """Every document's alignment with its links' counts, and the counts (``pair, a, b, n``).

    The first frame has ``row, doc_id, n_a, n_b, n_groups, n_links,
    groups_sha256, groups, n_best`` (links whose count is their A id's highest)
    and ``count_sum`` (over links).
    """
    own = aligner(path_a, path_b)
    aligned = align_documents(docs, path_a, path_b, doc_id, text, keep_groups)
    aligned = stored(aligned.withColumn("row", F.monotonically_increasing_id()), "token_align")
    counts = stored(pair_counts(aligned, own.size_b), "token_align_counts")
    return with_counts(aligned, counts, own.size_a, own.size_b, table_size), counts
