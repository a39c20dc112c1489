"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams (operator 10).

Features of a text, each present or not: words, their first ``STEM`` bytes (so
inflected forms share a feature), neighbouring pairs and pairs with one word
between them (skip-grams), hashed to ``BITS`` bits. Words are
runs of characters other than ASCII white space, ASCII letters lower-cased,
without punctuation at their ends.

Training: FTRL-proximal with per-coordinate learning rates and L1, one pass
after another over a bounded sample of labelled rows (``MAX_TRAIN_ROWS``, the
rows with the smallest hash of their id). The sample is the only data that
meets in one task. L1 leaves few non-zero weights, which are broadcast; their
number is at most 2 ** BITS. Scoring is a projection over all documents.

Defined cases: a null or empty text has no features and gets the score of the
bias alone; rows without a label, or with a null one, train nothing; an id
labelled both ways counts as toxic; a repeated doc_id trains once, with its
greatest text; without training rows every score is 0.5; an empty table gives
no rows.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import gathered, small_batches

BITS = 20
MAX_TRAIN_ROWS = 16_000
PASSES = 5
STEM = 5
ALPHA, BETA, L1, L2 = 1.0, 1.0, 4.0, 1.0
EDGES = b".,;:!?\"'()[]"
FOLDS, HELD_OUT = 5, 0
SLICE_BYTES = 8 << 20
_MAX_WORDS = 300_000


class _Code(dict):
    """Word to 64-bit code, kept for words met before."""

    def __missing__(self, word: bytes) -> int:
        w = word.strip(EDGES) or word
        code = self[word] = (zlib.crc32(w) << 32 | zlib.crc32(w, 0x9E3779B9)) & 0x7FFFFFFFFFFFFFFF
        return code


class _Stem(dict):
    """Word to the 64-bit code of its first letters."""

    def __missing__(self, word: bytes) -> int:
        code = self[word] = (zlib.crc32(word.strip(EDGES)[:STEM], 0x85EBCA6B) << 32 | zlib.crc32(word.strip(EDGES)[:STEM])) & 0x7FFFFFFFFFFFFFFF
        return code


_KNOWN, _STEMS = _Code(), _Stem()
_PAIR, _SKIP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_MIX = np.uint64(0xFF51AFD7ED558CCD)


def _hashed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * _MIX
    return (x >> np.uint64(64 - BITS)).astype(np.int64)


def features(texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and the text each belongs to (a feature may come repeatedly)."""
    if len(_KNOWN) > _MAX_WORDS:
        _KNOWN.clear()
        _STEMS.clear()
    code, stem, words, stems, sizes = _KNOWN.__getitem__, _STEMS.__getitem__, [], [], []
    for t in texts:
        own = t.encode("utf-8").lower().split() if t else []
        words.extend(map(code, own))
        stems.extend(map(stem, own))
        sizes.append(len(own))
    w = np.array(words, np.uint64)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    with np.errstate(over="ignore"):
        pair = w[:-1] * _PAIR + w[1:]
        skip = w[:-2] * _SKIP + (w[2:] ^ _PAIR)
    in_pair, in_skip = doc[:-1] == doc[1:], doc[:-2] == doc[2:]
    return (np.concatenate([_hashed(w), _hashed(np.array(stems, np.uint64)), _hashed(pair[in_pair]), _hashed(skip[in_skip])]),
            np.concatenate([doc, doc, doc[:-1][in_pair], doc[:-2][in_skip]]))


class Ftrl:
    """State of FTRL-proximal for 2 ** BITS features and a bias (the last)."""

    def __init__(self):
        self.z = np.zeros((1 << BITS) + 1)
        self.n = np.zeros((1 << BITS) + 1)

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, at: np.ndarray, label: int) -> None:
        """One example: its distinct features, bias included, each with value one."""
        w = self.weights(at)
        g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def fold_of(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS, passes: int = PASSES) -> list[tuple[int, float]]:
    """Non-zero weights as (feature, weight); feature 2 ** BITS is the bias."""
    spark = docs.sparkSession
    small_batches(spark)
    order = F.xxhash64("doc_id")
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")) \
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & (fold_of(F.col("doc_id")) != HELD_OUT))
    chosen = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(order, "doc_id").limit(max_rows)
    ids = spark.createDataFrame(chosen.collect(), chosen.schema)       # at most max_rows rows
    sample = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
              .join(F.broadcast(ids), "doc_id").groupBy("doc_id", "toxic").agg(F.max("text").alias("text")))

    def fit(batches):
        model, held = Ftrl(), []
        for b in batches:
            at, doc = features(b.column(1).to_pylist())
            key = np.unique(doc * (1 << BITS) + at)
            cuts = np.searchsorted(key, np.arange(b.num_rows + 1) * (1 << BITS))
            own = (key & ((1 << BITS) - 1)).astype(np.int32)
            for i, y in enumerate(b.column(0).to_pylist()):
                held.append((np.append(own[cuts[i]:cuts[i + 1]], np.int32(1 << BITS)), y))
        for _ in range(passes):
            for at, y in held:
                model.learn(at, y)
        w = model.weights()
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(w[at])], ["at", "w"])

    rows = sample.select("toxic", "text", order.alias("_o"), "doc_id").repartitionByRange(1, "_o").sortWithinPartitions("_o", "doc_id") \
        .select("toxic", "text").mapInArrow(fit, "at int, w double").collect()
    return [(r["at"], r["w"]) for r in rows]


def toxicity(docs: DataFrame, labels: DataFrame, **training) -> DataFrame:
    """doc_id, held_out, score and predicted for every document."""
    weights = train(docs, labels, **training)
    spark = docs.sparkSession
    at = np.array([w[0] for w in weights], np.int64)
    shared = spark.sparkContext.broadcast((at, np.array([w[1] for w in weights])))

    def score(batches):
        where, values = shared.value
        w = np.zeros((1 << BITS) + 1)
        w[where] = values
        for t in gathered(batches, SLICE_BYTES):
            feature, doc = features(t["text"].to_pylist())
            hit = w[feature] != 0
            key = np.unique(doc[hit] * (1 << BITS) + feature[hit])
            total = np.bincount(key >> BITS, weights=w[key & ((1 << BITS) - 1)], minlength=t.num_rows) + w[-1]
            yield pa.RecordBatch.from_arrays(
                [t["doc_id"].combine_chunks(), pa.array(1.0 / (1.0 + np.exp(-np.clip(total, -35, 35))))], ["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(score, "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(fold_of(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
