"""SimHash near-duplicates by the generalised pigeonhole principle (operator 9).

Fingerprints: ASCII letters lower-cased, words, shingles of ``SHINGLE`` words
(fewer words: all of them), XXH64 with seed 42; a bit is set if more than half
of the shingles' hashes set it. No words: zero.

Search over the distinct fingerprints, of which a group of copies has one:

1. Bits that are correlated over all fingerprints (a 64 x 64 matrix of
   co-occurrences, summed over partitions) are grouped into m partitions.
2. If the per-partition thresholds T add up to distance - m + 1 (each at least
   -1), two fingerprints within the distance agree within T[i] bits on some
   partition i. For each partition and threshold the number of candidates is
   estimated from exact counts of its values (threshold 0) and the model of
   independent bits (above); dynamic programming picks the cheapest T, and the
   cheapest m is taken.
3. Probe: each fingerprint is filed under its partition's value and the values
   within T[i] bits of it. Fingerprints filed together are compared in full
   (exclusive or, bit count). Large files are cut into chunks that meet pair
   by pair, so no task holds a whole hot file. A file gives a spanning star of
   each set of linked members instead of all its pairs.
4. Components: alternating large-star and small-star steps on the smallest
   doc_id of each fingerprint.

Defined cases: null and empty texts have fingerprint zero; repeated rows keep
a row each and share a component; a null doc_id never names a component unless
all of the component's are null; an empty table gives no rows.
"""
from __future__ import annotations

import math
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import KEY, NULL_ID, doc_key, free_name, pieces, small_batches, whole_groups, written

SHINGLE = 3
DISTANCE = 3
SEED = 42
BITS = 64
PARTITIONS = (2, 3, 4, 5)
CHUNK = 4096
SLICE_BYTES = 4 << 20
PROBE_COST = 4.0          # one filed signature, in candidate comparisons


def fingerprints_of(texts: list[str | None], n: int = SHINGLE) -> np.ndarray:
    """One unsigned 64-bit fingerprint for each text."""
    out = np.zeros(len(texts), np.uint64)
    for i, t in enumerate(texts):
        words = t.encode("utf-8").lower().split() if t else []
        if not words:
            continue
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate([[0], ends[:-1]])
        k = max(1, len(words) - n + 1)
        last = ends[min(n, len(words)) - 1:][:k] - 1
        cut = map(joined.__getitem__, map(slice, starts[:k].tolist(), last.tolist()))
        h = np.fromiter(map(xxhash.xxh64_intdigest, cut, repeat(SEED)), np.uint64, k)
        counts = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(k, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out[i] = np.packbits(counts * 2 > k, bitorder="little").view("<u8")[0]
    return out


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, a hash of the text and the fingerprint as a signed long, a row for each document."""
    small_batches(docs.sparkSession)

    def run(batches):
        for b in pieces(batches, SLICE_BYTES):
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(fingerprints_of(b.column(2).to_pylist(), shingle).view(np.int64))],
                ["doc_id", "tk", "fp"])

    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("tk"), text.alias("text")) \
        .mapInArrow(run, "doc_id long, tk long, fp long")


def group_bits(together: np.ndarray, n: int, m: int) -> list[list[int]]:
    """m groups of nearly equal size; each starts with the bit least tied to those
    taken and adds the bits most correlated with its own."""
    p = np.diag(together) / max(n, 1)
    dev = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs(together / max(n, 1) - np.outer(p, p)) / np.outer(dev, dev)
    np.fill_diagonal(corr, 0.0)
    free, groups = set(range(BITS)), []
    for g in range(m):
        size = (BITS - sum(map(len, groups))) // (m - g)
        taken = [b for own in groups for b in own]
        seed = min(free, key=lambda b: (corr[b, taken].sum(), b))
        own = [seed]
        free.discard(seed)
        while len(own) < size:
            best = max(free, key=lambda b: (corr[b, own].sum(), -b))
            own.append(best)
            free.discard(best)
        groups.append(sorted(own))
    return groups


def _within(differ: list[float], t: int) -> float:
    """Chance that at most t of independent bits differ."""
    dist = np.zeros(t + 2)
    dist[0] = 1.0
    for q in differ:
        dist[1:] = dist[1:] * (1 - q) + dist[:-1] * q
        dist[0] *= 1 - q
        dist[-1] = 0.0
    return float(dist[:t + 1].sum())


def allocate(pairs: list[float], widths: list[int], differ: list[list[float]], n: int, distance: int) -> tuple[float, list[int]]:
    """Cheapest thresholds that add up to distance - m + 1; pairs[i]: pairs that agree on partition i."""
    m = len(pairs)
    cost: list[dict[int, float]] = []
    for i in range(m):
        own = {-1: 0.0}
        none = max(_within(differ[i], 0), 1e-300)
        for t in range(distance + 1):
            probes = sum(math.comb(widths[i], k) for k in range(t + 1))
            own[t] = pairs[i] * max(1.0, _within(differ[i], t) / none) + PROBE_COST * n * probes
        cost.append(own)
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for own in cost:
        step: dict[int, tuple[float, list[int]]] = {}
        for total, (c, ts) in best.items():
            for t, x in own.items():
                if total + t not in step or c + x < step[total + t][0]:
                    step[total + t] = (c + x, ts + [t])
        best = step
    return best[distance - m + 1]


def _part(fp: np.ndarray, bits: list[int]) -> np.ndarray:
    """The bits of one partition, packed."""
    out = np.zeros(len(fp), np.uint64)
    for k, b in enumerate(bits):
        out |= ((fp >> np.uint64(b)) & np.uint64(1)) << np.uint64(k)
    return out


def _masks(width: int, t: int) -> np.ndarray:
    return np.array([sum(1 << b for b in own) for k in range(t + 1) for own in combinations(range(width), k)], np.uint64)


def plan(distinct: DataFrame, distance: int = DISTANCE) -> list[tuple[list[int], int]]:
    """Partitions (their bits) with the thresholds to probe them with; those at -1 are left out.

    What reaches the driver is one 64 x 64 matrix for each task, added up in
    Spark, and a count for each partition tried.
    """
    def matrix(batches):
        total, n = np.zeros((BITS, BITS), np.int64), 0
        for b in batches:
            fp = b.column(0).to_numpy().view(np.uint64)
            x = np.unpackbits(fp.astype("<u8").view(np.uint8).reshape(len(fp), 8), axis=1, bitorder="little").astype(np.float64)
            total += (x.T @ x).astype(np.int64)
            n += len(fp)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(BITS * BITS + 1), pa.int32()), pa.array(np.append(total.ravel(), n), pa.int64())], ["at", "n"])

    sums = {r["at"]: r["n"] for r in distinct.mapInArrow(matrix, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()}
    n = sums.get(BITS * BITS, 0)
    if n < 2:
        return []
    together = np.array([sums[k] for k in range(BITS * BITS)], float).reshape(BITS, BITS)
    tried = [group_bits(together, n, m) for m in PARTITIONS]
    flat = [bits for groups in tried for bits in groups]

    def values(batches):
        for b in batches:
            fp = b.column(0).to_numpy().view(np.uint64)
            for k, bits in enumerate(flat):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(fp), k), pa.int32()), pa.array(_part(fp, bits).view(np.int64))], ["k", "value"])

    counted = distinct.mapInArrow(values, "k int, value long").groupBy("k", "value").agg(F.count(F.lit(1)).cast("double").alias("n"))
    pairs = {r["k"]: r["p"] for r in counted.groupBy("k").agg((F.sum(F.col("n") * F.col("n")) / 2).alias("p")).collect()}
    p = np.diag(together) / n
    differ = 2 * p * (1 - p)
    best = None
    at = 0
    for groups in tried:
        own = [pairs[at + i] for i in range(len(groups))]
        at += len(groups)
        c, ts = allocate(own, [len(g) for g in groups], [differ[g].tolist() for g in groups], n, distance)
        if best is None or c < best[0]:
            best = (c, [(g, t) for g, t in zip(groups, ts) if t >= 0])
    return best[1]


def _stars(group: np.ndarray, fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (as row numbers) that join the members of each group within the distance of one another,
    directly or over others: each linked row and the first row of its set. Rows come sorted by group."""
    label = np.arange(len(fp))
    at = np.arange(len(fp) - 1)
    lag = 1
    while len(at):
        at = at[at + lag < len(fp)]
        at = at[group[at] == group[at + lag]]       # only groups larger than the lag go on
        near = at[np.bitwise_count(fp[at] ^ fp[at + lag]) <= distance]
        if len(near):
            _join(label, near, near + lag)
        lag += 1
    while True:
        up = label[label]
        if (up == label).all():
            break
        label = up
    linked = np.flatnonzero(label != np.arange(len(fp)))
    return linked, label[linked]


def _join(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merges the sets of a[i] and b[i] in a forest of labels that point to smaller rows."""
    while len(a):
        ra, rb = label[a], label[b]
        while True:
            ua, ub = label[ra], label[rb]
            if (ua == ra).all() and (ub == rb).all():
                break
            ra, rb = ua, ub
        label[a], label[b] = ra, rb
        low, high = np.minimum(ra, rb), np.maximum(ra, rb)
        open_ = low != high
        a, b, low, high = a[open_], b[open_], low[open_], high[open_]
        np.minimum.at(label, high, low)


def links(distinct: DataFrame, parts: list[tuple[list[int], int]], distance: int = DISTANCE, chunk: int = CHUNK) -> DataFrame:
    """Pairs (a, b) of fingerprints whose transitive closure is that of all pairs within the distance."""
    def file(batches):
        for b in batches:
            fp = b.column(0).to_numpy().view(np.uint64)
            for k, (bits, t) in enumerate(parts):
                own = _part(fp, bits)
                for mask in _masks(len(bits), t):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(fp), k), pa.int32()), pa.array((own ^ mask).view(np.int64)), b.column(0)], ["k", "value", "fp"])

    filed = distinct.mapInArrow(file, "k int, value long, fp long")
    # a table of its own: both sides of the join are then plain exchanges, whose hot partitions Spark splits
    sizes = written(filed.groupBy("k", "value").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1), "files")
    own = F.pmod(F.xxhash64("fp"), F.col("c"))
    cut = (filed.join(sizes, ["k", "value"]).withColumn("c", F.ceil(F.col("n") / chunk))
           .withColumn("i", own)
           # chunk i of a file meets every chunk j; a file of one chunk has the pair (0, 0) alone
           .select("k", "value", "fp", "i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("c") - 1)).alias("j"))
           .select(F.xxhash64("k", "value", F.least("i", "j"), F.greatest("i", "j")).alias("g"), "k", "value", "fp"))

    def compare(batches):
        for t in whole_groups(batches, "g", SLICE_BYTES):
            fp = t["fp"].to_numpy().view(np.uint64)
            a, b = _stars(t["g"].to_numpy(), fp, distance)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(fp[a].view(np.int64)), pa.array(fp[b].view(np.int64))], ["a", "b"])

    return (cut.select("g", "fp").repartition("g").sortWithinPartitions("g", "fp").mapInArrow(compare, "a long, b long").distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node each node of ``edges`` (a, b) is joined with, by alternating stars."""
    pairs = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    while True:
        # large star: every larger neighbour of u moves to u's least neighbour; the least ones are tables of
        # their own, so that Spark splits the partition of a node with very many neighbours in the joins
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = written(both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "edges")
        # small star: u and its smaller neighbours move to the least of them
        low = written(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = (large.join(low, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        pairs = written(small, "edges")
        now = pairs.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """doc_id, tk (hash of the text), fp (signed long), root (a fingerprint of the component) and
    component_id for every document."""
    rows = written(fingerprints(docs, shingle), "fingerprints")
    classes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    distinct = classes.select("fp")
    parts = plan(distinct, distance)
    if parts:
        joined = components(links(distinct, parts, distance))        # nodes are fingerprints
        roots = classes.join(joined, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
        names = roots.groupBy("root").agg(F.min("first").alias("component_id"))
        classes = written(roots.join(names, "root").select("fp", "root", "component_id"), "components")
    else:
        classes = classes.select("fp", F.col("fp").alias("root"), F.col("first").alias("component_id"))
    return rows.join(classes, "fp").select("doc_id", "tk", "fp", "root", "component_id")


def keep_first(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One document, all columns, of each component: the one with the smallest doc_id.

    Ties (one doc_id with several texts) go to the smallest hash of the text;
    of equal rows one stays; a null doc_id gives way to any other.
    """
    near = near_duplicates(docs, shingle, distance)
    kept = near.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "tk")).alias("d"))
    did, tk = (free_name(docs, c) for c in KEY)
    kept = kept.select(F.coalesce("d.doc_id", F.lit(NULL_ID)).alias(did), F.col("d.tk").alias(tk))
    keyed = docs.withColumns(dict(zip((did, tk), doc_key())))
    return keyed.join(kept, [did, tk], "left_semi").dropDuplicates([did, tk]).drop(did, tk)
