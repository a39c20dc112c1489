"""Exact substring deduplication by sparse suffix sorting (operator 2).

A byte goes if it is covered by a string of ``LENGTH`` bytes that also starts
elsewhere in the corpus. Two things keep this from sorting every suffix of the
corpus in one place:

* Anchors. Each window of LENGTH bytes has an anchor: the leftmost of its
  ``GRAM``-byte grams with the smallest hash. Equal windows have equal grams at
  equal offsets, so only windows with one anchor gram can be equal. Windows
  that share an anchor position form a segment. Grams that occur once in the
  corpus (nearly all) never leave their task: a Bloom filter of the grams seen
  twice, at most 128 MB, is built first, and what it lets through by chance
  is found out by the counts below.
* Pre-aggregation. Equal segments under one gram are one segment with a count;
  all windows of a segment that occurs twice repeat, and a gram with one
  distinct segment needs no ordering.

What remains, grams with several distinct segments, goes to the suffix sort.
The suffixes (window starts) of one gram and offset are ordered by deep-shallow
sorting: multikey quicksort, eight bytes a character and all open groups of a
level at once, to the depth ``SHALLOW``; groups that still agree there are
ordered by a blind trie, which branches on the first differing byte. A suffix
whose common prefix with a neighbour reaches LENGTH repeats.

Grams with more than ``HOT`` distinct segments are split before they reach a
task: windows are dealt by the hash of the bytes that all windows of their
offset class share, and equal parts are aggregated again. A part that still
has more than ``HOT`` pieces is not sorted at all: its windows are counted by
offset and a 128-bit hash of their bytes in a plain aggregation.

Texts are shuffled twice at most: those that own a segment to be sorted, and
those that lose something. Bloom filters of the documents' keys hold back the
others.

Defined cases: null and empty texts, and texts shorter than LENGTH bytes, lose
nothing; repeated rows are documents of their own, so all their windows
repeat; matches never cross documents; an empty table gives no rows.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm import seen_filter
from ledgerflow.llm.common import KEY, NULL_ID, doc_key, pieces, small_batches, whole_groups, written

LENGTH = 200
GRAM = 40
SHALLOW = 32
WORK_BYTES = 1 << 19          # of text in one pass of the anchor search; below 2 ** 20
PLACE_BITS = 20
SORT_BYTES = 4 << 20
HOT = 4000
CLASS = 17                    # offsets in one class when a hot gram is split

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[str, np.ndarray] = {}


def _powers() -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS:
        n = WORK_BYTES + LENGTH + 1
        up, down = np.empty(n, _U), np.empty(n, _U)
        for out, base in ((up, _BASE), (down, pow(_BASE, -1, 1 << 64))):
            out[0], size = 1, 1
            with np.errstate(over="ignore"):
                while size < n:                    # doubling: base ** (size + i) = base ** size * base ** i
                    step = min(size, n - size)
                    out[size:size + step] = out[:step] * _U(pow(base, size, 1 << 64))
                    size += step
        _POWERS["up"], _POWERS["down"] = up, down
    return _POWERS["up"], _POWERS["down"]


def gram_hashes(buf: np.ndarray, gram: int) -> np.ndarray:
    """A mixed 64-bit hash of the gram at each position."""
    up, down = _powers()
    n = len(buf)
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, _U)
        np.cumsum((buf.astype(_U) + _U(1)) * up[:n], out=sums[1:])
        h = (sums[gram:] - sums[:-gram]) * down[:n - gram + 1]
        h ^= h >> _U(32)
        h *= _U(0xD6E8FEB86659FD93)
        h ^= h >> _U(29)
    return h


def segments(buf: np.ndarray, valid: np.ndarray, length: int, gram: int):
    """First window, number of windows, anchor offset and gram hash of each segment; windows start
    where ``valid`` holds."""
    span = length - gram + 1
    h = gram_hashes(buf, gram)
    low = _U((1 << PLACE_BITS) - 1)
    least = (h & ~low) | np.arange(len(h), dtype=_U)
    size = 1
    while size * 2 <= span:                        # sliding minimum by doubling
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if span > size:
        least = np.minimum(least[:size - span], least[span - size:])
    starts = np.flatnonzero(valid[:len(least)])
    if not len(starts):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, _U),)
    anchor = (least[starts] & low).astype(np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(starts)))
    return starts[first], count, anchor[first] - starts[first], h[anchor[first]]


def _work(texts: list[bytes], length: int):
    """Buffers of bounded size with, for each byte, whether a window starts there, and the parts
    (document, place in it, place in the buffer, bytes) they are made of."""
    parts, size = [], 0
    for i, t in enumerate(texts):
        for at in range(0, max(0, len(t) - length + 1), WORK_BYTES - length):
            n = min(len(t) - at, WORK_BYTES - 1)
            if size + n > WORK_BYTES:
                yield parts
                parts, size = [], 0
            parts.append((i, at, size, n))
            size += n
    if parts:
        yield parts


def _buffers(batches, length: int, gram: int):
    """Segments of each buffer, with the batch, the texts and the parts it is made of."""
    for b in pieces(batches, 4 * WORK_BYTES):
        texts = [t.encode("utf-8") if t else b"" for t in b.column(2).to_pylist()]
        for parts in _work(texts, length):
            data = b"".join(texts[i][at:at + n] for i, at, _, n in parts)
            buf = np.frombuffer(data, np.uint8)
            valid = np.zeros(len(buf), bool)
            # a later part of a long text begins with the windows that the part before could not hold
            for i, at, place, n in parts:
                valid[place:place + min(n - length + 1, WORK_BYTES - length)] = True
            yield b, data, parts, segments(buf, valid, length, gram)


def _anchors(batches, length: int, gram: int, repeated: np.ndarray):
    """Segments whose gram may be seen twice."""
    for b, data, parts, (lo, count, offset, h) in _buffers(batches, length, gram):
        some = np.flatnonzero(seen_filter.passes(repeated, h)) if len(lo) else lo
        if not len(some):
            continue
        lo, count, offset, h = lo[some], count[some], offset[some], h[some]
        where = np.searchsorted([p[2] for p in parts], lo, side="right") - 1
        doc = np.array([p[0] for p in parts])[where]
        begin = lo - np.array([p[2] - p[1] for p in parts])[where]
        own = [xxhash.xxh3_64_intdigest(data[s:e]) for s, e in zip(lo.tolist(), (lo + count + (length - 1)).tolist())]
        take = pa.array(doc)
        yield pa.RecordBatch.from_arrays(
            [b.column(0).take(take), b.column(1).take(take), pa.array(begin, pa.int32()), pa.array(count, pa.int32()),
             pa.array(offset, pa.int32()), pa.array(h.view(np.int64)), pa.array(np.array(own, _U).view(np.int64))],
            [*KEY, "lo", "m", "a", "gram", "seg"])


class BlindTrie:
    """Orders strings of one length that share a prefix: inner nodes hold the place of the first
    differing byte, leaves a string; strings that agree throughout share a leaf."""

    def __init__(self):
        self.root = None

    def add(self, key: bytes) -> list[int]:
        """The members of the leaf that ``key`` belongs to (the caller adds to it)."""
        if self.root is None:
            self.root = (key, [])
            return self.root[1]
        node = self.root
        while type(node) is list:                  # blind descent: branching bytes only
            byte = key[node[0]]
            node = node[1].get(byte) or next(iter(node[1].values()))
        if node[0] == key:
            return node[1]
        bits = (int.from_bytes(node[0], "big") ^ int.from_bytes(key, "big")).bit_length()
        common = len(key) - (bits + 7) // 8
        leaf = (key, [])
        parent, node = None, self.root
        while type(node) is list and node[0] < common:
            parent, node = node, node[1][key[node[0]]]
        if type(node) is list and node[0] == common:
            node[1][key[common]] = leaf
        else:
            other = node
            while type(other) is list:
                other = next(iter(other[1].values()))
            branch = [common, {other[0][common]: node, key[common]: leaf}]
            if parent is None:
                self.root = branch
            else:
                parent[1][key[parent[0]]] = branch
        return leaf[1]

    def ordered(self):
        """Leaves in the order of their strings."""
        open_ = [self.root] if self.root is not None else []
        while open_:
            node = open_.pop()
            if type(node) is list:
                open_.extend(node[1][b] for b in sorted(node[1], reverse=True))
            else:
                yield node


def _words(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from each position, big end first (unaligned view)."""
    return np.ndarray((len(buf) - 7,), ">u8", buf, strides=(1,))


def deep_shallow(data: bytes, group: np.ndarray, start: np.ndarray, length: int, shallow: int = SHALLOW) -> np.ndarray:
    """For suffixes (bounded to ``length`` bytes) in groups: a class number for those that agree
    with a neighbour in suffix order throughout, -1 for all others.

    Shallow: multikey quicksort, a level at a time; a level splits every open
    group by its next eight bytes and closes groups of one. Deep: blind tries.
    """
    out = np.full(len(start), -1, np.int64)
    buf = np.frombuffer(data + b"\x00" * 8, np.uint8)
    words = _words(buf)
    at = np.arange(len(start))
    own = group
    depth = 0
    while len(at):
        order = np.lexsort((words[start[at] + depth], own)) if depth < shallow else np.argsort(own, kind="stable")
        at, own = at[order], own[order]
        new = np.ones(len(at), bool)
        new[1:] = own[1:] != own[:-1]
        if depth < shallow:
            w = words[start[at] + depth]
            new[1:] |= w[1:] != w[:-1]
        number = np.cumsum(new) - 1
        many = np.bincount(number)[number] > 1
        at, own = at[many], number[many]
        if depth >= shallow:
            break
        depth += 8
    if not len(at):
        return out
    bounds = np.append(np.flatnonzero(np.diff(own, prepend=-1)), len(at)).tolist()
    starts, ids, found = start[at].tolist(), at.tolist(), 0
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        trie = BlindTrie()
        for k in range(lo, hi):
            trie.add(data[starts[k] + depth:starts[k] + length]).append(ids[k])
        for _, members in trie.ordered():
            if len(members) > 1:
                out[members] = found
                found += 1
    return out


def repeated_windows(gram: np.ndarray, a: np.ndarray, m: np.ndarray, n: np.ndarray, data: list[bytes], length: int):
    """(segment, first, last) of runs of windows that repeat, for segments that come grouped by gram.

    Segments with a count of two or more repeat throughout; they take part so
    that others find them.
    """
    total = np.concatenate([[0], np.cumsum([len(d) for d in data])])
    which = np.repeat(np.arange(len(m)), m)
    k = np.arange(len(which)) - np.repeat(np.cumsum(m) - m, m)
    # only windows with one gram and one offset of the anchor can be equal
    _, number = np.unique(gram, return_inverse=True)
    group = number[which] * (length + 1) + (a[which] - k)
    same = deep_shallow(b"".join(data), group, total[which] + k, length)
    hit = (same >= 0) | (n[which] > 1)
    edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    first, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    for lo, hi in zip(first.tolist(), end.tolist()):
        while lo < hi:                             # a run may go on into the next segment
            stop = min(hi, lo + int(m[which[lo]] - k[lo]))
            yield int(which[lo]), int(k[lo]), int(k[stop - 1])
            lo = stop


_RUNS = "gram long, seg long, a int, m int, lo int, hi int"


def _sort(batches, length: int):
    for t in whole_groups(batches, "gram", SORT_BYTES):
        cols = [t[c].to_numpy() for c in ("gram", "a", "m", "n")]
        runs = list(repeated_windows(*cols, t["bytes"].to_pylist(), length))
        if runs:
            seg, lo, hi = (np.array(x) for x in zip(*runs))
            take = pa.array(seg)
            yield pa.RecordBatch.from_arrays(
                [*[t[c].combine_chunks().take(take) for c in ("gram", "seg", "a", "m")], pa.array(lo, pa.int32()), pa.array(hi, pa.int32())],
                ["gram", "seg", "a", "m", "lo", "hi"])


_PARTS = "hot boolean, part long, gram long, seg long, a int, m int, skip int, pa int, pm int, n long, bytes binary"


def _cut(batches, length: int):
    """Segments with their bytes: whole under their gram, or, of hot grams, in classes of offsets, each
    class under the hash of the bytes that all its windows share."""
    kinds = [pa.bool_()] + [pa.int64()] * 3 + [pa.int32()] * 5 + [pa.int64(), pa.binary()]
    names = [c.split()[0] for c in _PARTS.split(", ")]
    for b in batches:
        out = []
        for text, segs in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            data = text.encode("utf-8")
            for s in segs:
                a, m, lo, k = s["a"], s["m"], s["lo"], 0
                if not s["hot"]:
                    out.append((False, s["gram"], s["gram"], s["seg"], a, m, 0, a, m, s["n"], data[lo:lo + m - 1 + length]))
                    continue
                anchor = lo + a
                while k < m:                       # window k has the anchor at offset a - k
                    kind = (a - k) // CLASS
                    end = min(m, a - kind * CLASS + 1)
                    shared = data[anchor - kind * CLASS:anchor - (kind + 1) * CLASS + 1 + length]
                    key = xxhash.xxh3_64_intdigest(shared, seed=kind) - (1 << 63)
                    out.append((True, key, s["gram"], s["seg"], a, m, k, a - k, end - k, s["n"], data[lo + k:lo + end - 1 + length]))
                    k = end
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)


def _sorted_runs(cut: DataFrame, length: int) -> DataFrame:
    return cut.repartition("gram").sortWithinPartitions("gram").mapInArrow(lambda it: _sort(it, length), _RUNS)


def _merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return out


def _slim(docs: DataFrame) -> DataFrame:
    return docs.select(*doc_key(), F.col("text").cast("string").alias("text"))


def _repeated_grams(slim: DataFrame, length: int, gram: int) -> np.ndarray:
    """The filter of anchor grams seen twice or more."""
    size = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # a minimum of ``span`` hashes moves on at a random text about twice in a span
    bits = seen_filter.bits_for(2 * size // (length - gram + 2))
    return seen_filter.seen(slim, lambda batches: (s[3] for *_, s in _buffers(batches, length, gram)), bits, times=2)


def _counted_windows(pieces_: DataFrame, length: int) -> DataFrame:
    """Repeated windows of parts too large for one task, as runs of one window: counted by offset and hash."""
    windows = F.transform(F.sequence(F.lit(0), F.col("m") - 1), lambda k: F.unhex(F.md5(F.substring(F.col("bytes"), k + 1, F.lit(length)))))
    each = written(pieces_.select("gram", "seg", "a", "m", "n", F.posexplode(windows).alias("k", "w"))
                   .withColumn("off", F.col("a") - F.col("k")), "windows")
    again = written(each.groupBy("gram", "off", "w").agg(F.sum("n").alias("c")).where(F.col("c") > 1).drop("c"), "repeats")
    return each.join(again, ["gram", "off", "w"]).select("gram", "seg", "a", "m", F.col("k").alias("lo"), F.col("k").alias("hi"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """_did, _tk and spans (from, to): the parts of each document that windows repeated elsewhere cover."""
    spark = docs.sparkSession
    small_batches(spark)
    slim = _slim(docs)
    doc = F.xxhash64(*KEY)
    repeated = spark.sparkContext.broadcast(_repeated_grams(slim, length, gram))
    # tables of their own, here and below: both sides of a join are then plain exchanges, whose hot partitions Spark splits
    found = written(slim.mapInArrow(lambda it: _anchors(it, length, gram, repeated.value),
                                    "_did long, _tk long, lo int, m int, a int, gram long, seg long"), "anchors")
    ident = ["gram", "seg", "a", "m"]
    distinct = written(found.groupBy(*ident).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*KEY, "lo")).alias("at")), "segments")
    per_gram = written(distinct.groupBy("gram").agg(F.count(F.lit(1)).alias("d"), F.sum("n").alias("c")).where(F.col("c") > 1), "grams")
    tagged = written(distinct.join(per_gram, "gram"), "tagged")
    # one distinct segment, found twice or more: all of its windows repeat
    plain = tagged.where(F.col("d") == 1).select(*ident, F.array(F.struct(F.lit(0).alias("f"), (F.col("m") - 1).alias("t"))).alias("runs"))
    # several: order the suffixes of their distinct segments, each cut from the text of one document that has it
    mixed = tagged.where(F.col("d") > 1).select("at._did", "at._tk", F.struct(*ident, "n", "at.lo", (F.col("d") > hot).alias("hot")).alias("s"))
    owners = written(mixed.groupBy(*KEY).agg(F.collect_list("s").alias("segs")), "owners")
    texts = slim.where(seen_filter.seen_rows(owners, doc)(doc)).join(owners, KEY).dropDuplicates(KEY).select("text", "segs")
    parts = written(texts.mapInArrow(lambda it: _cut(it, length), _PARTS).withColumn("id", F.when(F.col("hot"), F.xxhash64("bytes"))), "parts")
    runs = _sorted_runs(parts.where(~F.col("hot")).select(*ident, "n", "bytes"), length)
    if parts.where("hot").limit(1).count():
        some = parts.where("hot")
        same = written(some.groupBy(F.col("part").alias("gram"), F.col("id").alias("seg"), F.col("pa").alias("a"), F.col("pm").alias("m"), "bytes")
                       .agg(F.sum("n").alias("n")).select("gram", "seg", "a", "m", "n", "bytes"), "pieces")
        large = written(same.groupBy("gram").agg(F.count(F.lit(1)).alias("d")).where(F.col("d") > hot).select("gram"), "large")
        in_parts = _sorted_runs(same.join(large, "gram", "left_anti"), length).unionByName(_counted_windows(same.join(large, "gram"), length))
        runs = runs.unionByName(some.drop("bytes").join(in_parts.toDF("part", "id", "pa", "pm", "lo", "hi"), ["part", "id", "pa", "pm"])
                                .select(*ident, (F.col("lo") + F.col("skip")).alias("lo"), (F.col("hi") + F.col("skip")).alias("hi")))
    sorted_ = runs.groupBy(*ident).agg(F.collect_set(F.struct(F.col("lo").alias("f"), F.col("hi").alias("t"))).alias("runs"))
    marks = written(plain.unionByName(sorted_), "runs")
    return (found.join(marks, ident).select(*KEY, "lo", F.inline("runs"))
            .select(*KEY, (F.col("lo") + F.col("f")).alias("from"), (F.col("lo") + F.col("t") + length).alias("to"))
            .groupBy(*KEY).agg(F.collect_set(F.struct("from", "to")).alias("spans")))


def drop_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """For each document doc_id, n_bytes, n_removed, n_spans and kept (the bytes that stay, binary)."""
    doc_id = F.when(F.col("_did") != NULL_ID, F.col("_did")).alias("doc_id")
    slim, doc = _slim(docs), F.xxhash64(*KEY)
    spans = written(repeated_spans(docs, length, gram, hot), "spans")
    loses = seen_filter.seen_rows(spans, doc)(doc)
    joined = slim.where(loses).join(spans, KEY, "left").select(doc_id, "text", "spans")
    text, none = F.coalesce("text", F.lit("")), F.lit(0).cast("long")
    whole = slim.where(~loses).select(doc_id, F.octet_length(text).cast("long").alias("n_bytes"), none.alias("n_removed"), none.alias("n_spans"),
                                      F.encode(text, "UTF-8").alias("kept"))

    def apply(batches):
        for b in batches:
            n, gone, runs, kept = [], [], [], []
            for t, spans in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                data = t.encode("utf-8") if t else b""
                cuts = _merged([(s["from"], s["to"]) for s in spans]) if spans else []
                stay, at = [], 0
                for lo, hi in cuts:
                    stay.append(data[at:lo])
                    at = hi
                stay.append(data[at:])
                n.append(len(data))
                kept.append(b"".join(stay))
                gone.append(len(data) - len(kept[-1]))
                runs.append(len(cuts))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(x, pa.int64()) for x in (n, gone, runs)], pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return joined.mapInArrow(apply, joined.select("doc_id").schema.add("n_bytes", "long").add("n_removed", "long")
                             .add("n_spans", "long").add("kept", "binary")).unionByName(whole)
