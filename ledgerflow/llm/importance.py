"""Importance resampling towards a target distribution (operator 12).

Words are runs of characters other than ASCII non-alphanumerics, ASCII letters
lower-cased. All separators of a text collapse to single spaces, so that every
run of k words is one stretch of bytes: a regular expression for k words, bound
by look-arounds at word edges and scanned with overlaps, gives the spans of all
k-grams, whose CRC-32 modulo ``buckets`` counts them (hashed n-gram features).

The corpus is scanned once; each text leaves its list of buckets (two bytes a
feature) in a table of the shared folder. From it come the corpus counts, one
row a bucket and task, and, with the gains of all buckets at hand, the weights.
A gain compares a bucket's share of the target's features with its share of the
corpus's, both smoothed by one. Gumbel noise from a hash of the id, added to the
weight, makes the highest scores a draw without replacement. Ranks come from one
range sort of narrow rows: counts of its partitions give each its offset.

Bounds: the gains are ``buckets`` longs, the offsets one row a partition; a task
holds one batch of texts. Nothing else is broadcast or collected.

Defined cases: a null or empty text has no features, weight 0, and is never
drawn, as it has fewer than ``min_words`` words; a null doc_id hashes as the empty
text and ranks before others of its score; repeated rows count and rank each
for itself; very long texts are scanned whole; empty tables give no rows, an
empty target gains from the smoothing alone; other columns are not read.
"""
from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import doc_key, free_name, pieces, small_batches, written

BUCKETS = 10_000
ORDERS = 1
SEED = 2024
PERCENT = 10
MIN_WORDS = 20
SLICE_BYTES = 4 << 20

# A-Z to a-z; every other ASCII byte but digits and a-z to the space.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_GAPS = re.compile(rb"  +")


def collapsed(text: str | None) -> bytes:
    """The words of a text in UTF-8, joined by single spaces."""
    return _GAPS.sub(b" ", text.encode("utf-8").translate(_FOLD)).strip(b" ") if text else b""


def gram_pattern(words: int) -> regex.Pattern:
    """Any run of ``words`` words in a collapsed text; to be scanned with overlaps."""
    return regex.compile(rb"(?<![^ ])[^ ]++(?: [^ ]++){%d}(?![^ ])" % (words - 1))


def spans(line: bytes, patterns: list[regex.Pattern]) -> Iterator[tuple[int, int]]:
    """Start and end of every n-gram of a collapsed text, order by order."""
    for p in patterns:
        for m in p.finditer(line, overlapped=True):
            yield m.span()


def bucket_list(line: bytes, patterns: list[regex.Pattern], buckets: int) -> np.ndarray:
    """Bucket of every n-gram of a collapsed text, repeats included."""
    crc = zlib.crc32
    return np.fromiter((crc(line[a:b]) for a, b in spans(line, patterns)), np.uint32) % np.uint32(buckets)


def _width(buckets: int) -> type:
    return np.uint16 if buckets <= 1 << 16 else np.uint32


def features(docs: DataFrame, orders: int = ORDERS, buckets: int = BUCKETS, keep: tuple[str, ...] = ()) -> DataFrame:
    """n_words, n_features and the packed bucket list of every text, beside the columns ``keep``."""
    small_batches(docs.sparkSession)
    kind = _width(buckets)
    fields = [docs.schema[c] for c in keep]

    def scan(batches):
        patterns = [gram_pattern(k) for k in range(1, orders + 1)]
        for b in pieces(batches, SLICE_BYTES):
            n_words, n_features, packed = [], [], []
            for t in b.column(len(keep)).to_pylist():
                line = collapsed(t)
                found = bucket_list(line, patterns, buckets)
                n_words.append(line.count(b" ") + 1 if line else 0)
                n_features.append(len(found))
                packed.append(found.astype(kind).tobytes())
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in range(len(keep))), pa.array(n_words, pa.int64()), pa.array(n_features, pa.int64()), pa.array(packed, pa.binary())],
                [*keep, "n_words", "n_features", "packed"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "n_words long", "n_features long", "packed binary"])
    return docs.select(*keep, F.col("text").cast("string").alias("text")).mapInArrow(scan, schema)


def bucket_counts(featured: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket and n of all features; a task sends at most one row a bucket."""
    kind = _width(buckets)

    def count(batches):
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for x in b.column(0):
                total += np.bincount(np.frombuffer(x.as_buffer(), kind), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], ["bucket", "n"])

    return featured.select("packed").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Gain of every bucket, from the counts of the corpus and of the target."""
    rows = (corpus.withColumn("t", F.lit(0).cast("long")).withColumnRenamed("n", "s")
            .unionByName(target.withColumn("s", F.lit(0).cast("long")).withColumnRenamed("n", "t")))
    spark = corpus.sparkSession
    every = spark.range(buckets).select(F.col("id").alias("bucket"), F.lit(0).cast("long").alias("s"), F.lit(0).cast("long").alias("t"))
    by = rows.unionByName(every).groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    sums = by.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t"))
    ratio = ((F.col("t") + 1) * (F.col("all_s") + buckets)).cast("double") / ((F.col("s") + 1) * (F.col("all_t") + buckets)).cast("double")
    return by.join(F.broadcast(sums)).select("bucket", F.floor(1000 * F.log(ratio)).alias("gain"))


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, from a hash of the id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))


def weighed(docs: DataFrame, target: DataFrame, orders: int = ORDERS, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """_did, _tk, doc_id, n_words, n_features, weight, score of every document, and its number _u, as a table."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    corpus = written(features(texts.select(*doc_key(), "doc_id", "text"), orders, buckets, ("_did", "_tk", "doc_id")), "grams")
    wanted = features(target, orders, buckets)
    gains = np.zeros(buckets, np.int64)
    for r in bucket_gains(bucket_counts(corpus, buckets), bucket_counts(wanted, buckets), buckets).collect():    # one row a bucket
        gains[r["bucket"]] = r["gain"]
    shared = spark.sparkContext.broadcast(gains)
    kind = _width(buckets)

    def weigh(batches):
        gain = shared.value
        for b in batches:
            weight = [int(gain[np.frombuffer(x.as_buffer(), kind)].sum()) for x in b.column(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(weight, pa.int64())], [*b.schema.names[:-1], "weight"])

    rows = corpus.mapInArrow(weigh, "_did long, _tk long, doc_id long, n_words long, n_features long, weight long")
    return written(rows.withColumns({"score": F.col("weight") + noise(F.col("doc_id"), seed), "_u": F.monotonically_increasing_id()}), "weights")


def ranked(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, **how) -> DataFrame:
    """The rows of ``weighed`` with their rank among the drawn (null: not drawn).

    Drawn are floor(percent * N / 100) of the N documents with ``min_words``
    words, those of the highest scores, ties to the smaller doc_id.
    """
    rows = weighed(docs, target, **how)
    fit = F.col("n_words") >= min_words
    n_drawn = rows.where(fit).count() * percent // 100
    # one sort of narrow rows; _u, stored with the rows, tells rows of equal score and id apart
    in_order = rows.orderBy(fit.desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_first(), "_u")
    placed = written(in_order.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}), "ranks")
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    offsets, before = [], 0
    for r in sizes.orderBy("_part").collect():          # one row a partition
        offsets.append((r["_part"], before - r["_first"]))
        before += r["_n"]
    shift = docs.sparkSession.createDataFrame(offsets, "_part int, _shift long")
    place = F.col("_at") + F.col("_shift") + 1
    return (placed.join(F.broadcast(shift), "_part")
            .withColumn("rank", F.when(fit & (place <= n_drawn), place)).drop("_part", "_at", "_shift", "_u"))


def resample(docs: DataFrame, target: DataFrame, **how) -> DataFrame:
    """The drawn documents with all their columns.

    Rows are found again by doc_id and text, so of rows equal in both, one
    stands for each drawn copy.
    """
    drawn = ranked(docs, target, **how).where(F.col("rank").isNotNull()).groupBy("_did", "_tk").agg(F.count(F.lit(1)).alias("_c"))
    did, tk, c = (free_name(docs, x) for x in ("_did", "_tk", "_c"))
    a, b = doc_key()
    keyed = docs.withColumns({did: a, tk: b})
    drawn = drawn.select(F.col("_did").alias(did), F.col("_tk").alias(tk), F.col("_c").alias(c))
    once = keyed.join(drawn, [did, tk]).dropDuplicates([did, tk])
    copy = free_name(once, "_copy")
    return once.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(c)))).select(*docs.columns)
