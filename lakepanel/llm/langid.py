"""Operator 3: language identification by multinomial naive Bayes.

Features are character n-grams (1 to ``max_n``) of the lower-cased text, with
every run of non-letters as one space, hashed into ``2**bits`` buckets.

* Training: Spark sums the bucket counts per language over labelled rows
  (each task sends one count vector per language).  At most ``max_docs``
  labelled rows are used (a parameter), the ones with the smallest
  ``xxhash64`` of their id, each with its whole text.
* The smoothed log-probability matrix (buckets x languages) is broadcast; its
  size is fixed by ``bits`` and the number of languages.
* Scoring: per text, whole, a sparse bucket-count vector times the matrix, in
  numpy; the result is the language of largest posterior and that posterior.
* The posterior only compares the learned languages with each other and is
  near 1 for any text of some length.  ``calibrate`` learns how likely texts of
  each language are: the mean log-probability per n-gram of pieces of ``PIECE``
  characters of the training rows, each under the counts of the other rows.
  ``typical_share`` is the part of a text whose pieces are at most ``REACH``
  times the distance from median to lower quartile below the median of some
  language; shorter texts, whose means vary more, get the distance in
  proportion to one over the root of their n-grams.

Defined results: null texts and texts without a letter get ``und`` and score
0; ties go to the language that sorts first; rows with null text or null
language teach nothing; without any labelled row every text is ``und``;
repeated rows give repeated results; an empty table gives an empty result;
columns other than id, text and language are ignored; the typical share of a
text without a letter is 0, and a language without a piece has no typical text.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship_package

UNDETERMINED = "und"
PIECE = 50  # characters
REACH = 10.0
_BINS = 100  # per unit of log-probability, of the pieces' histogram
_BLOCK = 1024  # pieces at once: bounds the working arrays of a long text


@dataclass
class Model:
    languages: list[str]
    log_prob: np.ndarray  # buckets x languages
    log_prior: np.ndarray
    bits: int
    max_n: int
    meta: dict = field(default_factory=dict)
    totals: np.ndarray | None = None  # smoothed n-gram count per language
    middle: np.ndarray | None = None  # of the pieces' mean log-probability: median per language
    spread: np.ndarray | None = None  # and its distance from the lower quartile


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """By code point: is it a letter?"""
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def code_points(text: str) -> np.ndarray:
    """Lower-cased code points; every run of non-letters behind a letter is one space; one more at either end."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points]
    points = np.where(letter, points, np.uint32(32))
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # of a run of non-letters, the first stays
    points = points[keep]
    return np.concatenate([[np.uint32(32)], points, [np.uint32(32)]]) if letter.any() else points[:0]


def buckets_by_length(points: np.ndarray, bits: int, max_n: int) -> list[np.ndarray]:
    """Hash buckets of the n-grams from each place on, for n from 1 to ``max_n``."""
    out, rolled = [], np.zeros(len(points), np.uint32)
    for n in range(1, max_n + 1):
        if len(points) < n:
            break
        rolled = rolled[: len(points) - n + 1] * np.uint32(0x01000193) + points[n - 1 :] + np.uint32(n)
        mixed = (rolled ^ (rolled >> np.uint32(15))) * np.uint32(0x9E3779B1)
        out.append(mixed >> np.uint32(32 - bits))
    return out


def buckets(points: np.ndarray, bits: int, max_n: int) -> np.ndarray:
    """Hash buckets of all n-grams of 1 to ``max_n`` characters."""
    out = buckets_by_length(points, bits, max_n)
    return np.concatenate(out) if out else np.empty(0, np.uint32)


def _sample(labelled: DataFrame, doc_id: str, text: str, lang: str, max_docs: int) -> DataFrame:
    """``text, lang`` of the rows that teach."""
    rows = labelled.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    rows = rows.where("lang IS NOT NULL").withColumn("draw", F.xxhash64("doc_id"))
    last = rows.select("draw").orderBy("draw").limit(max_docs).agg(F.max("draw")).first()[0]
    return rows.where(F.col("draw") <= F.lit(last if last is not None else 0)).where("text IS NOT NULL").select("lang", "text")


def fit(
    labelled: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    bits: int = 15,
    max_n: int = 3,
    max_docs: int = 20_000,
    smoothing: float = 0.5,
) -> Model:
    """Learn from at most ``max_docs`` labelled rows of ``labelled``."""
    ship_package(labelled.sparkSession)
    sample = _sample(labelled, doc_id, text, lang, max_docs)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}
        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = np.bincount(buckets(code_points(body), bits, max_n), minlength=1 << bits)
                sums[name] = sums[name] + found if name in sums else found
                docs[name] = docs.get(name, 0) + 1
        names = list(sums)
        for name in names:
            where = np.flatnonzero(sums[name])
            n = len(where)
            yield pa.record_batch(
                [pa.array([name] * (n + 1)), pa.array([*where.tolist(), -1], pa.int64()), pa.array([*sums[name][where].tolist(), docs[name]], pa.int64())],
                ["lang", "bucket", "n"],
            )

    counts = (
        sample.mapInArrow(count, "lang string, bucket bigint, n bigint")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .toPandas()  # languages x buckets numbers at most
    )
    languages = sorted(counts["lang"].unique())
    table = np.full((1 << bits, len(languages)), smoothing)
    prior = np.zeros(len(languages))
    for k, name in enumerate(languages):
        own = counts[counts["lang"] == name]
        docs = own[own["bucket"] < 0]["n"].sum()
        prior[k] = docs
        own = own[own["bucket"] >= 0]
        table[own["bucket"].to_numpy(), k] += own["n"].to_numpy()
    log_prob = np.log(table) - np.log(table.sum(axis=0, keepdims=True)) if languages else table
    return Model(languages, log_prob, np.log(prior / prior.sum()) if languages else prior, bits, max_n, totals=table.sum(axis=0))


def piece_means(points: np.ndarray, log_prob: np.ndarray, bits: int, max_n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Mean log-probability per n-gram (pieces x columns of ``log_prob``) and n-grams of a text's pieces, by blocks.

    An n-gram belongs to the piece it starts in; the last piece takes the rest.
    """
    pieces = max(1, len(points) // PIECE)
    for a in range(0, pieces, _BLOCK):
        z = min(a + _BLOCK, pieces)
        low, high = a * PIECE, z * PIECE if z < pieces else len(points)
        begin = np.arange(z - a) * PIECE
        total, n = np.zeros((z - a, log_prob.shape[1])), np.zeros(z - a, np.int64)
        for found in buckets_by_length(points[low : high + max_n - 1], bits, max_n):
            found = found[: high - low]
            total += np.add.reduceat(log_prob[found], begin, axis=0)
            n += np.diff(np.append(begin, len(found)))
        yield total / n[:, None], n


def calibrate(
    model: Model, labelled: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", max_docs: int = 20_000
) -> Model:
    """``model`` with what is typical of its languages, learned from the rows it was fitted on."""
    ship_package(labelled.sparkSession)
    shared = labelled.sparkSession.sparkContext.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        sums: dict[tuple[str, int], int] = {}
        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                points = code_points(body)
                if not len(points) or name not in own.languages:
                    continue
                k = own.languages.index(name)
                found = np.bincount(buckets(points, own.bits, own.max_n), minlength=1 << own.bits)
                used = np.flatnonzero(found)
                # The counts of the other rows: without this row's own.
                others = own.log_prob[:, k : k + 1].copy()
                left = np.exp(others[used, 0]) * own.totals[k] - found[used]
                others[used, 0] = np.log(np.maximum(left, 1e-3)) - np.log(own.totals[k])
                others += np.log(own.totals[k]) - np.log(own.totals[k] - found.sum())
                for means, _ in piece_means(points, others, own.bits, own.max_n):
                    for b, n in zip(*np.unique(np.floor(means * _BINS).astype(np.int64), return_counts=True), strict=True):
                        sums[name, int(b)] = sums.get((name, int(b)), 0) + int(n)
        keys = list(sums)
        yield pa.record_batch(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int64()), pa.array(list(sums.values()), pa.int64())],
            ["lang", "bin", "n"],
        )

    bins = (
        _sample(labelled, doc_id, text, lang, max_docs)
        .mapInArrow(measure, "lang string, bin bigint, n bigint")
        .groupBy("lang", "bin")
        .agg(F.sum("n").alias("n"))
        .orderBy("lang", "bin")
        .toPandas()  # a few thousand bins per language at most
    )
    middle, spread = np.full(len(model.languages), np.inf), np.zeros(len(model.languages))
    for k, name in enumerate(model.languages):
        own = bins[bins["lang"] == name]
        if len(own):
            reached = own["n"].cumsum().to_numpy()
            quartile, middle[k] = ((own["bin"].iloc[int(np.searchsorted(reached, reached[-1] * p))] + 0.5) / _BINS for p in (0.25, 0.5))
            spread[k] = middle[k] - quartile
    return replace(model, middle=middle, spread=spread)


def typical_share(model: Model, text: str | None) -> float:
    """The part of one whole text, in n-grams, that is typical of some language of a calibrated model."""
    points = code_points(text) if text else np.empty(0, np.uint32)
    if not len(points) or not model.languages:
        return 0.0
    good = total = 0
    for means, n in piece_means(points, model.log_prob, model.bits, model.max_n):
        wider = np.sqrt(np.maximum(1.0, PIECE * model.max_n / n))[:, None]
        typical = (means >= model.middle - REACH * np.maximum(model.spread, 1 / _BINS) * wider).any(axis=1)
        good, total = good + int(n[typical].sum()), total + int(n.sum())
    return good / total


def score(model: Model, text: str | None) -> tuple[str, float]:
    """The most probable language of one whole text and its posterior probability."""
    points = code_points(text) if text else np.empty(0, np.uint32)
    if not len(points) or not model.languages:
        return UNDETERMINED, 0.0
    counts = np.bincount(buckets(points, model.bits, model.max_n), minlength=1 << model.bits)
    used = np.flatnonzero(counts)
    log_like = counts[used] @ model.log_prob[used] + model.log_prior
    best = int(np.argmax(log_like))
    return model.languages[best], float(1.0 / np.exp(log_like - log_like[best]).sum())


def predict(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs``' columns ``keep`` (default: all) plus ``lang_pred`` and ``score``, which replace columns so named.

    A calibrated model also gives ``typical``, the text's typical share.
    """
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    added = ["lang_pred", "score"] + ["typical"] * (model.middle is not None)

    @F.pandas_udf("lang_pred string, score double" + ", typical double" * (len(added) == 3))
    def scored(texts: pd.Series) -> pd.DataFrame:
        own = shared.value
        if len(added) == 3:
            return pd.DataFrame([(*score(own, body), typical_share(own, body)) for body in texts], columns=added)
        return pd.DataFrame([score(own, body) for body in texts], columns=added)

    names = [c for c in (docs.columns if keep is None else keep) if c.lower() not in added]
    kept = docs.select(*[F.col(c) for c in names], scored(F.col(text)).alias("__scored"))
    return kept.select(*names, *[f"__scored.{c}" for c in added])


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """True for the fold that training never sees."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))
