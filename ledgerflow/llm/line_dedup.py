"""Line deduplication with two Bloom filters (operator 8).

A line's key is the line without white space at both ends, ASCII letters
lower-cased. Pass one sets bits for the keys of every document (once for each
key and document) in two Bloom filters: bits seen once and bits seen twice.
Tasks send sparse pieces of their filters, which meet piece by piece: a bit is
seen twice if one part saw it twice or two parts saw it once. Pass two emits
only keys all of whose bits were seen twice; these few shuffle for an exact
count by the key's text. Pass three sends the confirmed keys of each document
to it and drops their lines.

The filters' size follows the number of lines, up to ``MAX_BITS``, which also
bounds the broadcast (``MAX_BITS / 8`` bytes). A full filter costs suspects,
not results: confirmation is exact.

``keep_first`` spares the first line of each dropped key in the document with
the least doc_id (and text hash) that has it; otherwise all its lines go.

Defined cases: a null or empty text is one empty line; the empty key is never
dropped; repeated rows count as documents of their own and lose the same
lines; an empty table gives no rows; a null text stays null in the result.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import KEY, doc_key, free_name, pieces, small_batches, whole_groups, written

EDGES = b" \t\n\x0b\x0c\r"
MIN_DOCS = 10
BITS_FOR_A_LINE = 16
MIN_BITS, MAX_BITS = 1 << 20, 1 << 30
HASHES = 2
PART_BITS = 1 << 16
FLUSH_KEYS = 1 << 20
SLICE_BYTES = 4 << 20


def line_keys(text: bytes) -> list[bytes]:
    return [line.strip(EDGES).lower() for line in text.split(b"\n")]


def _places(keys: list[bytes], bits: int) -> np.ndarray:
    """HASHES bit numbers for each key."""
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))
    step = (h >> np.uint64(32)) | np.uint64(1)
    return np.stack([(h + np.uint64(k) * step) & np.uint64(bits - 1) for k in range(HASHES)])


def _parts(once: np.ndarray, twice: np.ndarray) -> pa.RecordBatch:
    """Sorted bit numbers as rows of (part, bits seen once, bits seen twice), two bytes a bit."""
    part = (once // PART_BITS).astype(np.int64)
    ids, at = np.unique(part, return_index=True)
    two = np.searchsorted(twice, np.concatenate([ids * PART_BITS, [1 << 62]]))
    low1, low2 = (once % PART_BITS).astype("<u2"), (twice % PART_BITS).astype("<u2")
    ends = np.append(at[1:], len(once))
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int32()), pa.array([low1[a:b].tobytes() for a, b in zip(at, ends)], pa.binary()),
         pa.array([low2[a:b].tobytes() for a, b in zip(two[:-1], two[1:])], pa.binary())], ["part", "once", "twice"])


def repeated_filter(texts: DataFrame, bits: int) -> np.ndarray:
    """The filter of keys seen in two documents, as bytes with 8 bits each."""
    spark = texts.sparkSession

    def mark(batches):
        held: list[np.ndarray] = []
        n = 0

        def flush():
            where, times = np.unique(np.concatenate(held), return_counts=True)
            return _parts(where, where[times > 1])

        for b in batches:
            for t in b.column(0).to_pylist():
                if keys := [k for k in set(line_keys(t.encode("utf-8"))) if k] if t else []:
                    held.append(_places(keys, bits).ravel())
                    n += len(keys)
            if n >= FLUSH_KEYS:
                yield flush()
                held, n = [], 0
        if held:
            yield flush()

    def merge(batches):
        for t in whole_groups(batches, "part", SLICE_BYTES):
            part, seen, again, out = None, None, None, []
            for p, once, twice in zip(*(t[c].to_pylist() for c in ("part", "once", "twice"))):
                if p != part:
                    if part is not None:
                        out.append((part, np.packbits(again).tobytes()))
                    part, seen, again = p, np.zeros(PART_BITS, bool), np.zeros(PART_BITS, bool)
                one = np.frombuffer(once, "<u2")
                again[one[seen[one]]] = True
                again[np.frombuffer(twice, "<u2")] = True
                seen[one] = True
            out.append((part, np.packbits(again).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.binary())], ["part", "twice"])

    merged = (texts.mapInArrow(mark, "part int, once binary, twice binary")
              .repartition("part").sortWithinPartitions("part").mapInArrow(merge, "part int, twice binary"))
    out = np.zeros(bits // 8, np.uint8)
    for row in merged.toLocalIterator():
        out[row.part * PART_BITS // 8:(row.part + 1) * PART_BITS // 8] = np.frombuffer(row.twice, np.uint8)
    return out


def drop_repeated_lines(docs: DataFrame, min_docs: int = MIN_DOCS, keep_first: bool = False) -> DataFrame:
    """The documents with what stays of their text, and the columns n_lines (before) and n_dropped."""
    spark = docs.sparkSession
    small_batches(spark)
    did, tk = (free_name(docs, c) for c in KEY)
    slim = docs.select(*doc_key(), F.col("text").cast("string").alias("text"))
    breaks = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"))) + 1
    n_lines = slim.agg(F.sum(breaks)).first()[0] or 0
    bits = min(MAX_BITS, max(MIN_BITS, 1 << int(BITS_FOR_A_LINE * n_lines - 1).bit_length() if n_lines else 0))
    repeats = spark.sparkContext.broadcast(repeated_filter(slim.select("text"), bits))

    def suspects(batches):
        twice = repeats.value
        for b in pieces(batches, SLICE_BYTES):
            rows: list[int] = []
            keys: list[bytes] = []
            for i, t in enumerate(b.column(2).to_pylist()):
                if t:
                    own = [k for k in set(line_keys(t.encode("utf-8"))) if k]
                    keys += own
                    rows += [i] * len(own)
            if not keys:
                continue
            at = _places(keys, bits)
            hit = np.flatnonzero(((twice[at >> np.uint64(3)] >> (7 - (at & np.uint64(7))).astype(np.uint8)) & 1).all(axis=0))
            take = pa.array(np.array(rows, np.int64)[hit])
            yield pa.RecordBatch.from_arrays(
                [pa.array([keys[i] for i in hit.tolist()], pa.binary()).cast(pa.string()), b.column(0).take(take), b.column(1).take(take)],
                ["line", *KEY])

    found = written(slim.mapInArrow(suspects, "line string, _did long, _tk long"), "lines")
    # a table of its own, so that both sides of the join below are plain exchanges, whose hot partitions Spark splits
    common = written(found.groupBy("line").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*KEY)).alias("first"))
                     .where(F.col("n") >= min_docs).select("line", "first"), "common")
    drops = (found.join(common, "line")
             .select(*KEY, F.struct("line", (F.lit(keep_first) & (F.struct(*KEY) == F.col("first"))).alias("first")).alias("d"))
             .groupBy(*KEY).agg(F.collect_set("d").alias("_drops")).toDF(did, tk, drops_name := free_name(docs, "_drops")))
    keyed = docs.withColumns(dict(zip((did, tk), doc_key())))
    joined = keyed.join(drops, [did, tk], "left").drop(did, tk)
    cols = [c for c in docs.columns]
    names = joined.columns
    at, where = names.index("text"), names.index(drops_name)
    out_names = [free_name(docs, "n_lines"), free_name(docs, "n_dropped")]
    schema = joined.drop(drops_name).schema.add(out_names[0], "long").add(out_names[1], "long")
    final = schema.names

    def apply(batches):
        for b in batches:
            texts, total, gone = [], [], []
            for t, drop in zip(b.column(at).to_pylist(), b.column(where).to_pylist()):
                total.append(t.count("\n") + 1 if t else 1)
                if not drop:
                    texts.append(t)
                    gone.append(0)
                    continue
                spare = {d["line"].encode("utf-8"): d["first"] for d in drop}
                lines = t.encode("utf-8").split(b"\n")
                stay = []
                for line in lines:
                    key = line.strip(EDGES).lower()
                    if (first := spare.get(key)) is None or first:
                        stay.append(line)
                        if first:
                            spare[key] = False
                texts.append(b"\n".join(stay).decode("utf-8"))
                gone.append(len(lines) - len(stay))
            arrays = [pa.array(texts, pa.string()) if c == "text" else b.column(i) for i, c in enumerate(names) if c != drops_name]
            yield pa.RecordBatch.from_arrays(arrays + [pa.array(total, pa.int64()), pa.array(gone, pa.int64())], final)

    return joined.mapInArrow(apply, schema).select(*cols, *out_names)
