"""Operator 10: token ids written as frequency-ranked variable-length bytes.

1. Every text is tokenised once; its ids are stored (two or four bytes each)
   below the shared checkpoint folder.
2. Ids are ranked by their count over all documents, so frequent ids get small
   numbers.  The rank table has one row per vocabulary entry, a size fixed by
   the tokenizer.
3. Documents are range-partitioned and sorted by id.  Each partition becomes
   one file of blocks; a block holds whole documents, up to ``block_ids`` ids
   (one document at least).
4. A block keeps its ranks in a byte-aligned code: a control byte gives the
   byte lengths (1 to 4) of four ranks, the data bytes follow in a column of
   their own.  Both directions are numpy table lookups over whole blocks.

The files are Parquet with one row per block (``control``, ``data`` and the
block's document ids and lengths).  They are written by Spark's commit
protocol, so a lost executor or a repeated task leaves no partial file, and
any store that Spark can write to will do.

A store is a folder that explains itself: ``blocks`` (the files above), ``ranks``
(token ids by rank) and ``about`` (id width, end id, the tokenizer file's
SHA-256), which is written last: without it the store is not complete and is
not read.  ``read_store`` needs the path only.

**Parts.** The tokenizer's normalizer and pre-tokenizer treat the parts between
white space separately, so a text's ids are the joined ids of its parts; in
texts of Latin letters, runs of letters, digits and runs of signs are parts
too.  ``ChunkEncoder`` checks this on the loaded tokenizer and encodes whole
texts where it does not hold.  A bounded cache in each worker keeps the ids of
parts seen before; all new parts of a slice are encoded in one library call.

Defined results: null and empty texts have the end id alone; a null document
id sorts first; rows that repeat an id are kept, in the order of their ids'
bytes; ids of equal count rank by the smaller id; texts of any length are
encoded whole; an empty table gives no files' rows; columns other than the id and the
text are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import work_dir
from .common import pieces, ship_package, stored

CACHE_ENTRIES = 3 << 19
LONGEST_KEY = 64

# ------------------------------------------------------------- variable length
_SHIFT = np.arange(0, 8, 2, dtype=np.uint8)
_CONTROL_LENGTHS = ((np.arange(256)[:, None] >> _SHIFT) & 3).astype(np.uint8) + 1


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit numbers."""
    ranks = np.ascontiguousarray(ranks, np.uint32)
    code = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    padded = np.zeros(-(-len(code) // 4) * 4, np.uint8)
    padded[: len(code)] = code
    control = np.bitwise_or.reduce(padded.reshape(-1, 4) << _SHIFT, axis=1)
    cells = ranks.astype("<u4").view(np.uint8).reshape(-1, 4)
    return control.astype(np.uint8).tobytes(), cells[np.arange(4, dtype=np.uint8) <= code[:, None]].tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` numbers behind control and data bytes."""
    lengths = _CONTROL_LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    cells = np.zeros((n, 4), np.uint8)
    cells[np.arange(4, dtype=np.uint8) < lengths[:, None]] = np.frombuffer(data, np.uint8)
    return cells.reshape(-1).view("<u4")


# ------------------------------------------------------------------- tokenising
# A text of ASCII and the Latin letters of U+00C0 to U+00FF, without an
# apostrophe or a special token, is cut further: letters, single digits, signs.
_ODD = re.compile(rb"[\xc0-\xc2\xc4-\xff]|\xc3[\x97\xb7]|'|<\|")
_PARTS = re.compile(rb"[a-z\x80-\xff]+|[0-9]|[^\sa-z0-9\x80-\xff]+")
# A part that is one word for certain: such letters, one digit, or ASCII signs.
_SINGLE = re.compile(rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+|[0-9]|[!-&(-/:-@\[-`{-~]+")
# The most common case, told apart without a regular expression: nothing but
# such letters, white space, and full stops and commas that stand alone.
_PLAIN = bytes(range(65, 91)) + bytes(range(97, 123)) + b" \t\n\r\x0b\x0c.,\xc3" + bytes(range(0x80, 0xC0))
_NOT_PLAIN = (b"..", b",,", b".,", b",.", b"\xc3\x97", b"\xc3\xb7")


class ChunkEncoder:
    """Text bytes -> ids (little-endian, ``width`` each), as the library gives them."""

    def __init__(self, tokenizer_path: str, width: str = "<u4"):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(tokenizer_path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.by_chunk = self._separable()
        self.last = self._word_ends()
        self.width = np.dtype(width)
        self.ids: dict[bytes, bytes] = {}

    def _separable(self) -> bool:
        """True if ASCII white space separates texts into independent parts."""
        added = self.tok.get_added_tokens_decoder().values()
        if any(t.lstrip or t.rstrip or any(c.isspace() for c in t.content) for t in added):
            return False
        marks = [(i, t.content) for i, t in self.tok.get_added_tokens_decoder().items() if t.special]
        if not marks:
            return False
        self.mark_id, self.mark = marks[0]
        probe = ["a", "1", "'s", "é", "é", "漢", "<|endoftext|>", "$$$", "́x"]
        apart = {p: self.tok.encode(p, add_special_tokens=False).ids for p in probe}
        def whole(t):
            return self.tok.encode(t, add_special_tokens=False).ids

        probes = ["Word.,", "É%%%a", "a-<b12", "ßx9!?Z", "_a[b]", "a\x00b\x1cc"]
        for p in probes:
            parts = _PARTS.findall(p.lower().encode())
            if whole(p) != [i for w in parts for i in whole(w.decode())]:
                return False
        return all(
            self.tok.encode(f"{s}{a}{s}{s}{b}{s}", add_special_tokens=False).ids == apart[a] + apart[b]
            for a in probe
            for b in probe
            for s in (" ", "\n", "\t", "\r", "\x0b", "\x0c")
        )

    def _word_ends(self) -> np.ndarray | None:
        """By token id: does it end a word?  None if the model does not say."""
        suffix = getattr(self.tok.model, "end_of_word_suffix", None)
        if not suffix:
            return None
        vocabulary = self.tok.get_vocab(with_added_tokens=True)
        out = np.zeros(max(vocabulary.values()) + 1, bool)
        out[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        return out

    def _whole(self, raw: bytes) -> bytes:
        return np.array(self.tok.encode(raw.decode(), add_special_tokens=False).ids, self.width).tobytes()

    def _joined(self, sign: str, parts: list[bytes]) -> np.ndarray:
        text = sign.encode().join(parts).decode()
        return np.array(self.tok.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.width)

    def _keep(self, parts: list[bytes], ids: np.ndarray, begin: np.ndarray, end: np.ndarray) -> None:
        raw, size = ids.tobytes(), self.width.itemsize
        for part, a, b in zip(parts, (begin * size).tolist(), (end * size).tolist(), strict=True):
            self.ids[part] = raw[a:b]

    def _learn(self, parts: list[bytes]) -> None:
        """Put the ids of ``parts`` into the cache, with a library call or two for all."""
        single = [p for p in parts if _SINGLE.fullmatch(p)] if self.last is not None else []
        if single:
            # One word each, so each ends with the one token that ends a word.
            ids = self._joined(" ", single)
            end = np.flatnonzero(self.last[ids]) + 1
            if len(end) == len(single):
                self._keep(single, ids, np.append(0, end[:-1]), end)
                done = set(single)
                parts = [p for p in parts if p not in done]
        mark = self.mark.encode()
        plain = [p for p in parts if mark not in p]
        if plain:
            ids = self._joined(self.mark, plain)
            cuts = np.flatnonzero(ids == self.mark_id)
            self._keep(plain, ids, np.append(0, cuts + 1), np.append(cuts, len(ids)))
        for p in parts:
            if mark in p:
                self.ids[p] = self._whole(p)

    def cut(self, raw: bytes | None) -> list[bytes]:
        """Parts of a text whose ids, joined, are the text's ids."""
        if not raw:
            return []
        if not raw.translate(None, _PLAIN) and not any(x in raw for x in _NOT_PLAIN):
            return raw.lower().replace(b".", b" . ").replace(b",", b" , ").split()
        return raw.split() if _ODD.search(raw) else _PARTS.findall(raw.lower())

    def encode_all(self, raws: list[bytes | None]) -> list[bytes]:
        """The ids of each text, in order; None counts as empty."""
        if not self.by_chunk:
            return [self._whole(raw) if raw else b"" for raw in raws]
        get, found, new = self.ids.get, [], set()
        for raw in raws:
            parts = self.cut(raw)
            ids = list(map(get, parts))
            places, words, at = [], [], -1
            if None in ids:
                for _ in range(ids.count(None)):
                    at = ids.index(None, at + 1)
                    places.append(at)
                    words.append(parts[at])
                new.update(words)
            found.append((ids, places, words))
        if new:
            self._learn(list(new))
        own, out = self.ids, []
        for ids, places, words in found:
            for at, part in zip(places, words, strict=True):
                ids[at] = own[part]
            out.append(b"".join(ids))
        for part in new:
            if len(part) > LONGEST_KEY:
                del own[part]
        if len(own) > CACHE_ENTRIES:
            own.clear()
        return out


_ENCODERS: dict[tuple[str, str], ChunkEncoder] = {}


def encoder_of(tokenizer_path: str, width: str) -> ChunkEncoder:
    """One encoder per process: a Python worker keeps its cache from task to task."""
    if (tokenizer_path, width) not in _ENCODERS:
        _ENCODERS[tokenizer_path, width] = ChunkEncoder(tokenizer_path, width)
    return _ENCODERS[tokenizer_path, width]


def tokenise(docs: DataFrame, tokenizer_path: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids`` (binary, little-endian; two bytes each if the vocabulary allows) with the end id last."""
    ship_package(docs.sparkSession)
    width = id_width(tokenizer_path, end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer_path, width)
        end = np.array([end_id], width).tobytes()
        for batch in batches:
            for part in pieces(batch, "text", 2 << 20):
                found = encoder.encode_all(part.column(1).cast(pa.large_binary()).to_pylist())
                yield pa.record_batch([part.column(0), pa.array([raw + end for raw in found], pa.binary())], ["doc_id", "ids"])

    kind = docs.select(doc_id).schema[0].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, f"doc_id {kind}, ids binary")


def id_width(tokenizer_path: str, end_id: int) -> str:
    from tokenizers import Tokenizer

    size = max(Tokenizer.from_file(tokenizer_path).get_vocab_size(with_added_tokens=True), end_id + 1)
    return "<u2" if size <= 1 << 16 else "<u4"


def rank_table(tokens: DataFrame, width: str) -> np.ndarray:
    """Token ids, most frequent first, by their counts over all documents.

    Each task counts its ids in one array; one row per id it saw is summed.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            raw = np.frombuffer(b"".join(x for x in batch.column(0).to_pylist()), width)
            if len(raw):
                n = np.bincount(raw)
                if len(n) > len(total):
                    total = np.pad(total, (0, len(n) - len(total)))
                total[: len(n)] += n
        seen = np.flatnonzero(total)
        yield pa.record_batch([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], ["id", "n"])

    rows = (
        tokens.select("ids")
        .mapInArrow(count, "id bigint, n bigint")
        .groupBy("id")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "id")
        .select("id")
        .collect()  # one row per vocabulary entry at most
    )
    return np.array([r["id"] for r in rows], np.uint32)


# ------------------------------------------------------------------------ files
ABOUT = "width string, end_id bigint, tokenizer_sha256 string, vocabulary bigint"


def write_store(tokens: DataFrame, ranked: np.ndarray, width: str, path: str, files: int, about: dict, block_ids: int = 1 << 18) -> None:
    """Write ``tokens`` to ``path``: blocks in ascending ``doc_id`` order, the ranks, and last what is needed to read them."""
    spark = tokens.sparkSession
    ranks = np.zeros(int(ranked.max()) + 1 if len(ranked) else 1, np.uint32)
    ranks[ranked] = np.arange(len(ranked), dtype=np.uint32)
    shared = spark.sparkContext.broadcast(ranks)
    kind = tokens.schema["doc_id"].dataType
    to_arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind.simpleString()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, lookup = None, 0, shared.value
        held: list[tuple[list, list[bytes]]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal block, held, size
            ids = [i for keys, _ in held for i in keys]
            raws = [raw for _, some in held for raw in some]
            values = np.frombuffer(b"".join(raws), width)
            control, data = pack(lookup[values])
            lengths = [len(raw) // np.dtype(width).itemsize for raw in raws]
            out = pa.record_batch(
                [
                    pa.array([part], pa.int32()),
                    pa.array([block], pa.int32()),
                    pa.array([len(values)], pa.int64()),
                    pa.array([ids], pa.list_(to_arrow)),
                    pa.array([lengths], pa.list_(pa.int64())),
                    pa.array([control], pa.binary()),
                    pa.array([data], pa.binary()),
                ],
                ["part", "block", "n_ids", "doc_ids", "lengths", "control", "data"],
            )
            block, held, size = block + 1, [], 0
            return out

        for batch in batches:
            keys, raws, parts = (batch.column(k).to_pylist() for k in range(3))
            for key, raw, p in zip(keys, raws, parts, strict=True):
                n = len(raw) // np.dtype(width).itemsize
                if held and (size + n > block_ids or p != part):
                    yield flush()
                part = p
                held.append(([key], [raw]))
                size += n
        if held:
            yield flush()

    (
        tokens.repartitionByRange(files, F.col("doc_id").asc_nulls_first())
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "ids")
        .withColumn("part", F.spark_partition_id())
        .mapInArrow(
            run,
            f"part int, block int, n_ids bigint, doc_ids array<{kind.simpleString()}>, "
            "lengths array<bigint>, control binary, data binary",
        )
        .write.option("compression", "none")
        .parquet(f"{path}/blocks")
    )
    spark.createDataFrame([(bytearray(ranked.astype("<u4").tobytes()),)], "ids binary").coalesce(1).write.parquet(f"{path}/ranks")
    row = [(width, about["end_id"], about["tokenizer_sha256"], len(ranked))]
    spark.createDataFrame(row, ABOUT).coalesce(1).write.json(f"{path}/about")


def about_store(spark: SparkSession, path: str) -> dict:
    """Width, end id, tokenizer hash and vocabulary size of a complete store."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/about/_SUCCESS")
    if not jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath):
        raise FileNotFoundError(f"{path} holds no complete token store")
    return spark.read.schema(ABOUT).json(f"{path}/about").first().asDict()


def read_store(spark: SparkSession, path: str, ranked: np.ndarray | None = None) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32, ids`` of every document in the store at ``path``.

    The ranks come from the store, unless the caller still has them.

    ``start`` counts the ids of all documents before it: a running sum over
    the blocks' sizes (one small row per block) plus the place in the block.
    """
    about_store(spark, path)
    if ranked is None:  # one number per vocabulary entry at most
        ranked = np.frombuffer(spark.read.parquet(f"{path}/ranks").first()["ids"], "<u4")
    blocks = spark.read.parquet(f"{path}/blocks")
    # Two levels, so that no task sees the blocks of more than one file.
    files = blocks.groupBy("part").agg(F.sum("n_ids").alias("file_ids"))
    files = files.select("part", (F.sum("file_ids").over(Window.orderBy("part")) - F.col("file_ids")).alias("file_start"))
    sizes = blocks.select("part", "block", "n_ids")
    w = Window.partitionBy("part").orderBy("block")
    starts = sizes.withColumn("in_file", F.sum("n_ids").over(w) - F.col("n_ids")).join(files, "part")
    starts = starts.select("part", "block", (F.col("file_start") + F.col("in_file")).alias("block_start"))
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    shared = spark.sparkContext.broadcast(ranked.astype("<u4"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for row in frame.itertuples(index=False):
                ids = shared.value[unpack(row.control, row.data, int(row.n_ids))]
                ends = np.cumsum(np.asarray(row.lengths, np.int64))
                begins = ends - np.asarray(row.lengths, np.int64)
                raws = [ids[a:b].tobytes() for a, b in zip(begins, ends, strict=True)]
                yield pd.DataFrame(
                    {
                        "doc_id": list(row.doc_ids),
                        "start": begins + int(row.block_start),
                        "n_tokens": ends - begins,
                        "ids_crc32": [zlib.crc32(raw) for raw in raws],
                        "ids": raws,
                    }
                )

    return blocks.join(starts, ["part", "block"]).select(
        "doc_ids", "lengths", "n_ids", "control", "data", "block_start"
    ).mapInPandas(run, f"doc_id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint, ids binary")


def build_store(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int = 2,
    doc_id: str = "doc_id",
    text: str = "text",
    ids_per_file: int = 1 << 23,
) -> tuple[str, np.ndarray]:
    """Tokenise ``docs`` and write the files; returns their path and the rank table."""
    spark = docs.sparkSession
    width = id_width(tokenizer_path, end_id)
    tokens = stored(tokenise(docs, tokenizer_path, end_id, doc_id, text), "token_ids")
    ranked = rank_table(tokens, width)
    total = tokens.agg(F.sum(F.octet_length("ids"))).first()[0] or 0
    files = int(total // (np.dtype(width).itemsize * ids_per_file)) + 1
    path = work_dir(spark, "llm", "token_store")
    about = {"end_id": end_id, "tokenizer_sha256": hashlib.sha256(Path(tokenizer_path).read_bytes()).hexdigest()}
    write_store(tokens, ranked, width, path, max(files, spark.sparkContext.defaultParallelism), about)
    return path, ranked
