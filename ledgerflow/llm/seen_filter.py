"""Bloom filters of 64-bit keys, built by Spark tasks and merged piece by piece.

Tasks send sparse pieces of their filters, two bytes a bit; pieces of one part
of the filter meet in one task, a part being ``PART_BITS`` bits. A bit counts as
seen twice if one piece saw it twice or two pieces saw it once. The filter is at
most ``MAX_BITS``, which bounds what is collected and broadcast; a full filter
passes more keys than need be, never fewer.
"""
from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import whole_groups

BITS_FOR_A_KEY = 16
MIN_BITS, MAX_BITS = 1 << 20, 1 << 30
HASHES = 2
PART_BITS = 1 << 16
FLUSH_KEYS = 1 << 18
MERGE_BYTES = 4 << 20


def bits_for(keys: int) -> int:
    """Size of the filter for about so many keys: a power of two within the bounds."""
    return min(MAX_BITS, max(MIN_BITS, 1 << max(0, int(BITS_FOR_A_KEY * keys) - 1).bit_length()))


def _places(h: np.ndarray, bits: int) -> np.ndarray:
    h = h.astype(np.uint64, copy=False)
    step = (h >> np.uint64(32)) | np.uint64(1)
    with np.errstate(over="ignore"):
        return np.concatenate([(h + np.uint64(k) * step) & np.uint64(bits - 1) for k in range(HASHES)])


def _piece(held: list[np.ndarray]) -> pa.RecordBatch:
    """One piece a part: low 16 bits of the places seen, and of those seen twice or more."""
    place, times = np.unique(np.concatenate(held), return_counts=True)
    part = (place // np.uint64(PART_BITS)).astype(np.int32)
    low = (place % np.uint64(PART_BITS)).astype("<u2")
    cut = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(part))
    again = times > 1
    spans = list(zip(cut[:-1].tolist(), cut[1:].tolist()))
    return pa.RecordBatch.from_arrays(
        [pa.array(part[cut[:-1]]), pa.array([low[a:b].tobytes() for a, b in spans], pa.binary()),
         pa.array([low[a:b][again[a:b]].tobytes() for a, b in spans], pa.binary())], ["part", "once", "twice"])


def seen(df: DataFrame, hashes: Callable[[Iterable[pa.RecordBatch]], Iterator[np.ndarray]], bits: int, times: int = 1) -> np.ndarray:
    """The filter of the keys that ``hashes`` draws from the rows of ``df`` once or more, or twice or more; 8 bits a byte."""
    def mark(batches):
        held: list[np.ndarray] = []
        n = 0
        for h in hashes(batches):
            if len(h):
                held.append(_places(h, bits))
                n += len(h)
            if n >= FLUSH_KEYS:
                yield _piece(held)
                held, n = [], 0
        if held:
            yield _piece(held)

    def merge(batches):
        for t in whole_groups(batches, "part", MERGE_BYTES):
            part, one, two, out = None, None, None, []
            for p, once, twice in zip(*(t[c].to_pylist() for c in ("part", "once", "twice"))):
                if p != part:
                    if part is not None:
                        out.append((part, np.packbits(one if times == 1 else two).tobytes()))
                    part, one, two = p, np.zeros(PART_BITS, bool), np.zeros(PART_BITS, bool)
                at = np.frombuffer(once, "<u2")
                two[at[one[at]]] = True
                two[np.frombuffer(twice, "<u2")] = True
                one[at] = True
            out.append((part, np.packbits(one if times == 1 else two).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.binary())], ["part", "bits"])

    merged = (df.mapInArrow(mark, "part int, once binary, twice binary")
              .repartition("part").sortWithinPartitions("part").mapInArrow(merge, "part int, bits binary"))
    out = np.zeros(bits // 8, np.uint8)
    for row in merged.toLocalIterator():
        out[row.part * PART_BITS // 8:(row.part + 1) * PART_BITS // 8] = np.frombuffer(row.bits, np.uint8)
    return out


def passes(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether each key may be in the filter."""
    at = _places(h, len(bitmap) * 8)
    hit = (bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (7 - (at & np.uint64(7))).astype(np.uint8)) & 1
    return hit.reshape(HASHES, len(h)).all(axis=0)


def seen_rows(df: DataFrame, key: Column) -> Callable[[Column], Column]:
    """A condition for other tables: may this long key be among the keys of ``df``?

    The key alone goes to Python, not the row.
    """
    keys = df.select(key.alias("k"))
    bits = bits_for(df.count())
    shared = df.sparkSession.sparkContext.broadcast(seen(keys, lambda batches: (b.column(0).to_numpy(zero_copy_only=False) for b in batches), bits))

    @F.arrow_udf("boolean")
    def maybe(k: pa.Array) -> pa.Array:
        return pa.array(passes(shared.value, k.to_numpy(zero_copy_only=False)))

    return maybe
