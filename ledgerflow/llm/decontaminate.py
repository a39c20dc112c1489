"""Benchmark decontamination by pigeonhole edit matching (operator 7).

A test item of L characters has an error budget e = floor(rate * L). If a
document holds a copy with at most e edits, at least one of e + 1 pieces that
the item is split into occurs in it unchanged. All pieces of a block of items
go into one Aho-Corasick automaton; a document is scanned once, and each hit
names an item and the place where its copy must lie, within e characters.
That stretch is verified with Myers' bit-parallel edit distance (the item may
end anywhere in it); matches within the budget count.

Items are taken in blocks of a bounded number of characters, so the broadcast
never grows with the benchmark; documents are scanned in place and not
shuffled. Items and documents are compared with ASCII letters lower-cased and
white space collapsed to single spaces.

Items shorter than ``MIN_CHARS`` after normalising have no error budget: they
match as they stand, where no letter or digit at their ends runs on in the
document. Such an item may be one word, which every document with that word holds.

Defined cases: a null or empty document holds nothing; items that are null or
blank match nothing; repeated item texts match each under their own id; repeated rows of
documents give a row each; empty tables give no rows.
"""
from __future__ import annotations

import uuid

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import small_batches

ERROR_RATE = 0.06
MIN_CHARS = 24
BLOCK_CHARS = 4_000_000
_BUILT: dict[str, "Matcher"] = {}


def normal(text: str | None) -> str:
    return " ".join(text.encode("utf-8").lower().decode("utf-8").split()) if text else ""


def split_pieces(length: int, n: int) -> list[tuple[int, int]]:
    """``n`` pieces (start, end) of nearly equal size that cover ``length`` characters."""
    return [(length * k // n, length * (k + 1) // n) for k in range(n)]


def myers(masks: dict[str, int], m: int, text: str, limit: int) -> tuple[int, int]:
    """Least edit distance of the pattern to a part of ``text`` and that part's end
    (its first such end); (limit + 1, -1) if above ``limit``."""
    full, high = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best, end = full, 0, m, limit + 1, -1
    for at, c in enumerate(text):
        eq = masks.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
        ph, mh = ph << 1 & full, mh << 1 & full
        pv = mh | ~(xv | ph) & full
        mv = ph & xv
        if score < best:
            best, end = score, at + 1
    return best, end


def whole_words(text: str, start: int, end: int) -> bool:
    """No word of ``text`` is cut at either end of the stretch."""
    return not any(0 < at < len(text) and text[at - 1].isalnum() and text[at].isalnum() for at in (start, end))


class Matcher:
    def __init__(self, items: list[tuple[int, str]], rate: float):
        self.items, self.budget, self.masks = [], [], []
        pieces: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            t = normal(text)
            if not t:
                continue
            k, e = len(self.items), int(rate * len(t)) if len(t) >= MIN_CHARS else 0
            self.items.append((item_id, t))
            self.budget.append(e)
            self.masks.append(None)
            for a, b in split_pieces(len(t), e + 1):
                pieces.setdefault(t[a:b], []).append((k, a))
        self.tree = ahocorasick.Automaton()
        for p, where in pieces.items():
            self.tree.add_word(p, (len(p), where))
        if pieces:
            self.tree.make_automaton()

    def _masks(self, k: int) -> dict[str, int]:
        if self.masks[k] is None:
            self.masks[k] = {}
            for i, c in enumerate(self.items[k][1]):
                self.masks[k][c] = self.masks[k].get(c, 0) | 1 << i
        return self.masks[k]

    def find(self, text: str) -> list[tuple[int, int, int]]:
        """(item id, distance, end in the normalised text) of each item that ``text`` holds."""
        if not self.items:
            return []
        places: dict[int, set[int]] = {}
        for end, (size, where) in self.tree.iter(text):
            for k, a in where:
                places.setdefault(k, set()).add(end + 1 - size - a)
        out = []
        for k, starts in sorted(places.items()):
            item_id, item = self.items[k]
            e, m = self.budget[k], len(item)
            exact = min((s for s in starts if s >= 0 and text.startswith(item, s) and (m >= MIN_CHARS or whole_words(text, s, s + m))), default=None)
            if exact is not None:
                out.append((item_id, 0, exact + m))
                continue
            if m < MIN_CHARS:
                continue
            best, at = e + 1, -1
            lo = hi = None
            for s in [*sorted(starts), None]:           # stretches that overlap are verified as one
                if lo is not None and (s is None or s - e > hi):
                    d, end = myers(self._masks(k), m, text[lo:hi], e)
                    if d < best:
                        best, at = d, lo + end
                    lo = None
                if s is not None:
                    lo = max(0, s - e) if lo is None else lo
                    hi = s + m + e
            if best <= e:
                out.append((item_id, best, at))
        return out


def _matcher(shared) -> Matcher:
    """Built once in each Python worker for a broadcast block of items."""
    if shared.value[0] not in _BUILT:
        _BUILT.clear()
        _BUILT[shared.value[0]] = Matcher(*shared.value[1:])
    return _BUILT[shared.value[0]]


def _blocks(benchmark: DataFrame, rate: float):
    """Broadcast blocks of items, each of about ``BLOCK_CHARS`` characters."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")) \
        .where(F.length("text") > 0)
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-chars // BLOCK_CHARS)
    for b in range(n):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).collect()
        rows = sorted((r.item_id if r.item_id is not None else -1, r.text, r.item_id) for r in own)
        yield spark.sparkContext.broadcast((uuid.uuid4().hex, [(r[2], r[1]) for r in rows], rate))


def contaminated(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """One row per document and test item it holds: doc_id, item_id, distance, end_char
    (where the best copy ends in the document's normalised text)."""
    spark = docs.sparkSession
    small_batches(spark)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, item_id long, distance int, end_char int"
    out = spark.createDataFrame([], schema)
    for block in _blocks(benchmark, rate):
        def scan(batches, block=block):
            m = _matcher(block)
            for b in batches:
                rows = [(i, *hit) for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for hit in m.find(normal(t))]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int32(), pa.int32()))],
                        ["doc_id", "item_id", "distance", "end_char"])
        out = out.unionByName(src.mapInArrow(scan, schema))
    return out


def without_contaminated(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """The documents, all columns, that hold no test item; each is judged where it lies."""
    small_batches(docs.sparkSession)
    at = docs.columns.index("text")
    out = docs
    for block in _blocks(benchmark, rate):
        def keep(batches, block=block):
            m = _matcher(block)
            for b in batches:
                yield b.filter(pa.array([not m.find(normal(t)) for t in b.column(at).to_pylist()], pa.bool_()))
        out = out.mapInArrow(keep, docs.schema)
    return out
