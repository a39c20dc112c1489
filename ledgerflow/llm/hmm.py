"""Hidden Markov language model of word sequences (operator 6).

Tokens: ASCII letters lower-cased, words (runs of characters other than space
and U+0009-U+000D), then one end token. The model: K latent states with start
and transition probabilities; a state emits one of ``BUCKETS`` word classes
(crc32 of the word); a class emits its words by add-one smoothed counts, with
one share for words that training has not seen:

    P(text) = P(classes of the tokens) * product of (c + 1) / (N_b + V_b + 1)

(c: the token's count; N_b, V_b: tokens and distinct tokens of its class). So
the whole vocabulary counts, while what states share is of fixed size and can
be broadcast (K * BUCKETS numbers).

Training: word counts, then ``ITERATIONS`` rounds of Baum-Welch over all
training texts. Each task runs scaled forward and backward recursions and
gives its expected counts; Spark adds them up by class. Long texts are cut
into stretches of ``STRETCH`` tokens for training (all of them count; those
that don't begin a text start from the average state distribution).

Scoring: the scaled forward recursion over the whole text gives the exact
likelihood. Counts of frequent words (at most ``MAX_FREQUENT``) are broadcast;
all others are looked up by a join on the word.

Defined cases: a null or empty text is the end token alone; a null doc_id is
not held out; repeated rows count and are scored each; without training rows
V and N are zero and every token is new; an empty table gives no rows.
"""
from __future__ import annotations

import zlib
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import gathered, small_batches, written

STATES = 6
BUCKETS = 1 << 14
ITERATIONS = 3
STRETCH = 512
MAX_FREQUENT = 1 << 17
COUNT_BYTES = 8 << 20
TRAIN_BYTES = 4 << 20
SCORE_BYTES = 6 << 20
FOLDS, HELD_OUT = 7, 2
PRIOR = 200.0             # tokens' worth of the overall class distribution in each state
END = b""


class Model(NamedTuple):
    start: np.ndarray     # K
    average: np.ndarray   # K: mean state distribution
    move: np.ndarray      # K x K
    emit: np.ndarray      # K x BUCKETS


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == HELD_OUT, F.lit(False))


def tokens_of(texts: list[str | None]) -> tuple[list[bytes], np.ndarray]:
    """All tokens one text after the other, and the number of each text's."""
    words: list[bytes] = []
    sizes = np.ones(len(texts), np.int64)
    for i, t in enumerate(texts):
        if t:
            own = t.encode("utf-8").lower().split()
            words += own
            sizes[i] += len(own)
        words.append(END)
    return words, sizes


def classes_of(words: list[bytes]) -> np.ndarray:
    return (np.fromiter(map(zlib.crc32, words), np.uint32, len(words)) % BUCKETS).astype(np.int64)


def forward(model: Model, obs: np.ndarray, starts: np.ndarray, sizes: np.ndarray, begins: np.ndarray, keep: bool):
    """Scaled forward recursion over many sequences at once.

    Sequence i is obs[starts[i]:starts[i] + sizes[i]], longest first; begins
    says whether it starts a text. Returns the natural log likelihoods and,
    with ``keep``, for each step the classes, scaled state distributions
    (K x sequences) and scales of the sequences that are that long.
    """
    steps = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(steps), side="left")       # sequences longer than t
    loglik = np.zeros(len(sizes))
    a = np.where(begins, model.start[:, None], model.average[:, None])
    seen = []
    for t in range(steps):
        k = active[t]
        o = obs[starts[:k] + t]
        a = (model.move.T @ a[:, :k] if t else a) * np.take(model.emit, o, axis=1)
        c = a.sum(axis=0)
        a /= c
        loglik[:k] += np.log(c)
        if keep:
            seen.append((o, a, c))
    return loglik, seen


def expected_counts(model: Model, obs: np.ndarray, starts: np.ndarray, sizes: np.ndarray, begins: np.ndarray):
    """Baum-Welch expected counts: starts (K), moves (K x K) and emissions (K x BUCKETS), and the log likelihood."""
    loglik, seen = forward(model, obs, starts, sizes, begins, keep=True)
    states = len(model.start)
    moves, first = np.zeros((states, states)), np.zeros(states)
    beta = np.ones((states, len(sizes)))
    gammas = []
    for t in range(len(seen) - 1, -1, -1):
        o, a, c = seen[t]
        own = beta[:, :len(c)]
        gammas.append(a * own)
        if t:
            ahead = own * np.take(model.emit, o, axis=1) / c
            moves += seen[t - 1][1][:, :len(c)] @ ahead.T
            beta[:, :len(c)] = model.move @ ahead
        else:
            first = gammas[-1][:, begins].sum(axis=1)
    if not seen:
        return first, moves, np.zeros((states, BUCKETS)), 0.0
    classes, gamma = np.concatenate([x[0] for x in reversed(seen)]), np.concatenate(gammas, axis=1)
    emits = np.stack([np.bincount(classes, weights=g, minlength=BUCKETS) for g in gamma])
    return first, moves * model.move, emits, float(loglik.sum())


def _stretches(sizes: np.ndarray, longest: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, sizes and whether a text begins there, longest first."""
    ends = np.cumsum(sizes)
    starts = ends - sizes
    begins = np.ones(len(sizes), bool)
    if longest:
        n = -(-sizes // longest)
        which = np.repeat(np.arange(len(sizes)), n)
        k = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        starts, sizes, begins = starts[which] + k * longest, np.minimum(longest, sizes[which] - k * longest), k == 0
    order = np.argsort(-sizes, kind="stable")
    return starts[order], sizes[order], begins[order]


def word_counts(texts: DataFrame) -> DataFrame:
    """word (binary; the end token is empty), c and class b of all tokens of the one-column ``texts``."""
    def count(batches):
        for t in gathered(batches, COUNT_BYTES):
            words, _ = tokens_of(t[0].to_pylist())
            own = Counter(words)
            yield pa.RecordBatch.from_arrays([pa.array(list(own), pa.binary()), pa.array(list(own.values()), pa.int64())], ["word", "n"])

    return (texts.mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))
            .withColumn("b", F.pmod(F.crc32("word"), F.lit(BUCKETS)).cast("int")))


def train(texts: DataFrame, class_tokens: np.ndarray, iterations: int = ITERATIONS, states: int = STATES) -> Model:
    """Baum-Welch from a start near the overall class distribution, the same in every run."""
    spark = texts.sparkSession
    rng = np.random.default_rng(11)
    prior = (class_tokens + 1.0) / (class_tokens.sum() + BUCKETS)
    emit = prior * rng.uniform(0.5, 1.5, (states, BUCKETS))
    move = np.full((states, states), 0.1 / max(1, states - 1))
    np.fill_diagonal(move, 0.9 if states > 1 else 1.0)
    even = np.full(states, 1.0 / states)
    model = Model(even, even, move, emit / emit.sum(axis=1, keepdims=True))
    for _ in range(iterations):
        shared = spark.sparkContext.broadcast(tuple(model))

        def expect(batches, shared=shared):
            m = Model(*shared.value)
            k = len(m.start)
            total = [np.zeros(k), np.zeros((k, k)), np.zeros((k, BUCKETS))]
            for t in gathered(batches, TRAIN_BYTES):
                words, sizes = tokens_of(t[0].to_pylist())
                obs = classes_of(words)
                del words
                for sum_, own in zip(total, expected_counts(m, obs, *_stretches(sizes, STRETCH))):
                    sum_ += own
            rows = np.vstack([total[2].T, total[1], total[0][None, :]])
            used = np.flatnonzero(rows.any(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), *[pa.array(rows[used, s]) for s in range(k)]],
                                             ["at", *[f"s{s}" for s in range(k)]])

        own = texts.mapInArrow(expect, "at int, " + ", ".join(f"s{s} double" for s in range(states)))
        sums = own.groupBy("at").agg(*[F.sum(f"s{s}").alias(f"s{s}") for s in range(states)]).toArrow()
        rows = np.zeros((BUCKETS + states + 1, states))
        rows[sums["at"].to_numpy()] = np.stack([sums[f"s{s}"].to_numpy() for s in range(states)], axis=1)
        emit = rows[:BUCKETS].T + PRIOR * prior
        move = rows[BUCKETS:-1] + 1.0
        start = rows[-1] + 1.0
        average = rows[:BUCKETS].sum(axis=0) + 1.0
        model = Model(start / start.sum(), average / average.sum(), move / move.sum(axis=1, keepdims=True),
                      emit / emit.sum(axis=1, keepdims=True))
        shared.unpersist()
    return model


def _frequent(counts: DataFrame) -> tuple[int, dict[bytes, int]]:
    """A count above which at most MAX_FREQUENT words lie, and those words' counts."""
    level = F.floor(F.log2("c")).cast("int")
    words, least = 0, 1 << 62
    for r in sorted(counts.groupBy(level.alias("l")).agg(F.count(F.lit(1)).alias("n")).collect(), key=lambda r: -r["l"]):
        words += r["n"]
        if words > MAX_FREQUENT:
            break
        least = 1 << r["l"]
    top = counts.where(F.col("c") >= least).select("word", "c").toArrow()
    return least, dict(zip(top["word"].to_pylist(), top["c"].to_pylist()))


def score(docs: DataFrame, iterations: int = ITERATIONS, states: int = STATES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score for every document."""
    spark = docs.sparkSession
    small_batches(spark)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    seen = src.where(~held_out(F.col("doc_id"))).select("text")
    counts = written(word_counts(seen), "words")
    by_class = counts.groupBy("b").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect()
    tokens, distinct = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in by_class:
        tokens[r["b"]], distinct[r["b"]] = r["n"], r["v"]
    total, vocabulary = int(tokens.sum()), int(distinct.sum())
    model = train(seen, tokens, iterations, states)
    least, frequent = _frequent(counts)
    shared = spark.sparkContext.broadcast((tuple(model), np.log10(tokens + distinct + 1), frequent))

    def run(batches):
        parts, inside, common = shared.value
        m, number, place = Model(*parts), 0, TaskContext.get().partitionId() << 36
        gain = {w: np.log10(c + 1.0) for w, c in common.items()}
        for t in gathered(batches, SCORE_BYTES):
            words, sizes = tokens_of(t["text"].to_pylist())
            obs = classes_of(words)
            starts, ordered, begins = _stretches(sizes, None)
            loglik, _ = forward(m, obs, starts, ordered, begins, keep=False)
            ll = np.empty(len(sizes))
            ll[np.argsort(-sizes, kind="stable")] = loglik
            got = list(map(gain.get, words))
            rare = [i for i, x in enumerate(got) if x is None]
            doc = np.repeat(np.arange(len(sizes)), sizes)
            value = np.array([0.0 if x is None else x for x in got])
            known = np.ones(len(words), np.int64)
            known[rare] = 0
            add = lambda x: np.bincount(doc, weights=x, minlength=len(sizes))
            times = Counter(zip(doc[rare].tolist(), map(words.__getitem__, rare)))
            keys = sorted(times, key=lambda k: k[0])
            bounds = np.searchsorted([k[0] for k in keys], np.arange(len(sizes) + 1))
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.StructArray.from_arrays(
                [pa.array([k[1] for k in keys], pa.binary()), pa.array([times[k] for k in keys], pa.int32())], ["word", "n"]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(place + number + np.arange(len(sizes))), t["doc_id"].combine_chunks(), pa.array(sizes),
                 pa.array(add(known).astype(np.int64)), pa.array(add(value)), pa.array(ll / np.log(10) - add(inside[obs])), lists],
                ["rid", "doc_id", "n_tokens", "known", "gain", "fixed", "rare"])
            number += len(sizes)

    scored = written(src.mapInArrow(
        run, "rid long, doc_id long, n_tokens long, known long, gain double, fixed double, rare array<struct<word: binary, n: int>>"), "scored")
    rare = scored.select("rid", F.inline("rare"))
    found = (rare.join(counts.where(F.col("c") < least).select("word", "c"), "word")
             .groupBy("rid").agg(F.sum("n").alias("more"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("more_gain")))
    gain = F.col("gain") + F.coalesce("more_gain", F.lit(0.0))
    return scored.drop("rare").join(found, "rid", "left").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0))).cast("long").alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (gain - F.col("n_tokens") * float(np.log10(total + vocabulary + 1))).alias("base_score"),
        (gain + F.col("fixed")).alias("score"))
