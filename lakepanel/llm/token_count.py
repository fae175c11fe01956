"""Operator 9: token counts by a map-side two-tier lookup.

A text's token count is the sum over its pre-tokens, so a count needs a
lookup per pre-token, not an encoding:

* tier 1: a broadcast table of the corpus's most frequent pre-tokens and
  their lengths (at most ``table_size`` entries);
* tier 2: a bounded cache in each Python worker; only what both tiers miss
  is encoded by the library.

Pre-tokens never cross a shuffle.  The table is made from all documents: each
task counts its own pre-tokens and sends only its ``per_task`` most frequent
ones, which are summed.  The table changes speed only, never a count.

**Pre-tokens.** In a sentencepiece model whose normalizer is the identity, the
text becomes ``▁text`` with spaces as ``▁``.  If no piece of the vocabulary has
a ``▁`` behind another character and none holds a line feed, then no merge
crosses the place before a run of ``▁`` or either side of a line feed, and
the text may be cut there.  ``PreTokenCounter`` checks these conditions on
the loaded model and encodes whole texts where one fails.

Defined results: null and empty texts have 0 bytes and 0 tokens; texts of any
length are counted whole, with runs of spaces cut apart first; a null id is
kept; repeated rows give repeated results; an empty table gives an empty
result; columns other than the id and the text are ignored.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship_package

CACHE_ENTRIES = 1 << 19
LONGEST_KEY = 64
_SPACE = "▁"
_MARK = _SPACE.encode()
# Runs of spaces and space marks with what follows up to the next one, or a line feed.
_WORD = rb"(?:[^ \n\xe2]+|\xe2(?!\x96\x81))"
_SLOW = re.compile(b"(?: |" + _MARK + b")+" + _WORD + b"*|" + _WORD + b"+|\n")


class _Lengths(dict):
    """Pre-token -> number of tokens; a missing one is encoded, and kept while there is room."""

    def __init__(self, frequent: dict, encode):
        super().__init__(frequent)
        self._fixed, self._encode = frequent, encode

    def __missing__(self, key: bytes) -> int:
        n = self._encode(key)
        if len(key) <= LONGEST_KEY:
            if len(self) >= CACHE_ENTRIES + len(self._fixed):
                self.clear()
                self.update(self._fixed)
            self[key] = n
        return n


class PreTokenCounter:
    """Counts the tokens of texts for one sentencepiece model."""

    def __init__(self, model_path: str, frequent: dict | None = None):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.by_parts = self._separable()
        self.lengths = _Lengths(frequent or {}, self._part_length)
        self.loose = _Lengths({}, self._loose_length)

    def _separable(self) -> bool:
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        proto.ParseFromString(self.sp.serialized_model_proto())
        norm = proto.normalizer_spec
        plain = (
            not norm.precompiled_charsmap
            and norm.add_dummy_prefix
            and not norm.remove_extra_whitespaces
            and norm.escape_whitespaces
            and not proto.trainer_spec.treat_whitespace_as_suffix
            and proto.trainer_spec.model_type == pb.TrainerSpec.BPE
        )
        inner = re.compile(f"[^{_SPACE}]{_SPACE}|\n")
        alone = self.sp.encode("\n", out_type=str)
        return (
            plain
            and len(alone) == 2
            and alone[0] == _SPACE
            and not any(p.type == p.USER_DEFINED for p in proto.pieces)
            and not any(inner.search(p.piece) for p in proto.pieces)
        )

    def _part_length(self, key: bytes) -> int:
        """Tokens of ``▁word`` for ``word``, of a line feed and what follows for ``\\nword``."""
        if key[:1] == b"\n":
            return len(self.sp.encode(key.decode())) - 1  # the prefix's own ▁
        return len(self.sp.encode("\n " + key.decode())) - 2  # the prefix's ▁ and the line feed

    def _loose_length(self, part: bytes) -> int:
        """Tokens of a part of a text with runs of spaces: the run and its word, or a word behind a line feed."""
        return len(self.sp.encode("\n" + part.decode())) - 2  # the prefix's ▁ and the line feed

    @staticmethod
    def parts(raw: bytes) -> list[bytes] | None:
        """Pre-tokens of a text with single spaces; None if the text needs the slow cut."""
        if b"  " in raw or raw[:1] == b" " or b"\xe2\x96\x81" in raw:
            return None
        return raw.replace(b"\n", b" \n").split(b" ")

    def _slow(self, raw: bytes) -> int:
        """A text with runs of spaces, a space in front, or the space mark itself: its plain parts by the same table."""
        total = 0
        for part in _SLOW.findall(b" " + raw):
            if part == b"\n":
                total += 1
            elif part[:1] == b" " and part[1:2] not in (b"", b" ") and _MARK not in part:
                total += self.lengths[part[1:]]
            else:
                total += self.loose[part]
        return total

    def count(self, raw: bytes) -> int:
        if not raw:
            return 0
        if not self.by_parts:
            return len(self.sp.encode(raw.decode()))
        parts = self.parts(raw)
        if parts is None:
            return self._slow(raw)
        if raw[:1] == b"\n":  # the text's own prefix stands alone before a line feed
            return 1 + sum(map(self.lengths.__getitem__, parts[1:]))
        return sum(map(self.lengths.__getitem__, parts))


def _texts(batch: pa.RecordBatch, column: str) -> list:
    return batch.column(batch.schema.get_field_index(column)).cast(pa.large_binary()).to_pylist()


def frequent_pre_tokens(docs: DataFrame, text: str = "text", table_size: int = 1 << 16, per_task: int = 1 << 13) -> list[bytes]:
    """The most frequent pre-tokens over all documents, most frequent first.

    At most ``per_task`` rows leave a task and ``table_size`` reach the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for raw in _texts(batch, "text"):
                if raw:
                    parts = PreTokenCounter.parts(raw)
                    # Runs of spaces take no part in the table, the words between them do.
                    seen.update(parts if parts is not None else filter(None, raw.replace(b"\n", b" \n").split(b" ")))
            if len(seen) > 16 * per_task:
                seen = Counter({k: n for k, n in seen.items() if n > 1})
                if len(seen) > 16 * per_task:
                    seen = Counter(dict(seen.most_common(8 * per_task)))
        top = heapq.nlargest(per_task, ((n, k) for k, n in seen.items() if len(k) <= LONGEST_KEY))
        yield pa.record_batch([pa.array([k for _, k in top], pa.binary()), pa.array([n for n, _ in top], pa.int64())], ["part", "n"])

    top = (
        docs.select(F.col(text).alias("text"))
        .mapInArrow(count, "part binary, n bigint")
        .groupBy("part")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "part")
        .limit(table_size)
    )
    return [bytes(r["part"]) for r in top.collect()]


def count_tokens(
    docs: DataFrame,
    model_path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    limit: int = 4096,
    table_size: int = 1 << 16,
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` per row of ``docs``, without special tokens."""
    spark = docs.sparkSession
    ship_package(spark)
    counter = PreTokenCounter(model_path)
    table = {}
    if counter.by_parts:
        table = {part: counter._part_length(part) for part in frequent_pre_tokens(docs, text, table_size)}
    shared = spark.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = PreTokenCounter(model_path, shared.value)
        for batch in batches:
            raws = [raw or b"" for raw in _texts(batch, "text")]
            counts = [own.count(raw) for raw in raws]
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array([len(raw) for raw in raws], pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array([n > limit for n in counts], pa.bool_()),
                ],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    kind = docs.select(doc_id).schema[0].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean"
    )
