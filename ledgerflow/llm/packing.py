"""Vector bin packing of token sequences (operator 4).

Each example is a vector of tokens, segments (one) and loss-bearing tokens; a
sequence has a limit on each. Every input partition packs its own examples in
blocks of a bounded number of text bytes, so nothing is shuffled and blocks
are independent at any scale.

Within a block, pieces that fill a sequence are cut from long examples first.
The rest is placed by the dot-product heuristic: the open sequence takes the
example that fits and whose demand vector has the largest dot product with
the sequence's remaining capacity (both as shares of the limits). When none
fits, the one with the largest product is cut to what still fits and its rest
goes back. A sequence that must close unfilled (no example left in the block,
or the segment limit is reached) is cut into sequences whose lengths are
powers of two, which need no padding.

Defined cases: a null text is the empty text and has the end id only; a null
prompt is empty; repeated rows are packed each on their own; an empty table
gives no rows; further columns are ignored.
"""
from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import gathered, give_back, small_batches
from ledgerflow.llm.encode import encoder
from ledgerflow.llm.token_files import with_end

MAX_TOKENS = 2048
MAX_SEGMENTS = 256
BLOCK_BYTES = 8 << 20
PARTITION_SHIFT = 36      # sequence ids: partition number above, count within the partition below

Piece = tuple[int, int, int]    # example, start, length


def _loss(start: int, length: int, prompt: int) -> int:
    return max(0, start + length - max(start, prompt))


def _longest(start: int, prompt: int, tokens: int, loss: int) -> int:
    """Longest piece from ``start`` within the limits on tokens and loss-bearing tokens."""
    return min(tokens, max(0, prompt - start) + loss)


def pack_block(lengths: np.ndarray, prompts: np.ndarray, max_tokens: int = MAX_TOKENS,
               max_segments: int = MAX_SEGMENTS, max_loss: int | None = None) -> list[list[Piece]]:
    """Sequences of pieces: every token of every example lies in exactly one piece."""
    max_loss = max_tokens if max_loss is None else max_loss
    if min(max_tokens, max_segments, max_loss) < 1:
        raise ValueError("limits must be positive")
    out: list[list[Piece]] = []
    start = np.zeros(len(lengths), np.int64)
    left = lengths.astype(np.int64).copy()
    for i in np.flatnonzero(left >= max_tokens).tolist():
        while left[i] >= max_tokens and _longest(int(start[i]), int(prompts[i]), max_tokens, max_loss) == max_tokens:
            out.append([(i, int(start[i]), max_tokens)])
            start[i] += max_tokens
            left[i] -= max_tokens
    ids = np.flatnonzero(left > 0)
    tok, begin, pro = left[ids], start[ids], prompts.astype(np.int64)[ids]
    los = np.maximum(0, begin + tok - np.maximum(begin, pro))
    while len(ids):
        seq: list[Piece] = []
        r_tok, r_seg, r_los = max_tokens, max_segments, max_loss
        while len(ids) and r_tok and r_seg:
            score = tok * (r_tok / max_tokens ** 2) + r_seg / max_segments ** 2 + los * (r_los / max_loss ** 2)
            fit = (tok <= r_tok) & (los <= r_los)
            if fit.any():
                j = int(np.argmax(np.where(fit, score, -1.0)))
                n = int(tok[j])
            else:
                j = int(np.argmax(score))
                n = _longest(int(begin[j]), int(pro[j]), r_tok, r_los)
                if n == 0:                       # only loss-bearing tokens are left and none may be added
                    break
            seq.append((int(ids[j]), int(begin[j]), n))
            used = _loss(int(begin[j]), n, int(pro[j]))
            r_tok, r_seg, r_los = r_tok - n, r_seg - 1, r_los - used
            if n == tok[j]:
                keep = len(ids) - 1
                for a in (ids, tok, begin, pro, los):
                    a[j] = a[keep]
                ids, tok, begin, pro, los = ids[:keep], tok[:keep], begin[:keep], pro[:keep], los[:keep]
            else:
                begin[j] += n
                tok[j] -= n
                los[j] -= used
        out.extend([seq] if r_tok == 0 else _powers_of_two(seq))
    return out


def _powers_of_two(seq: list[Piece]) -> list[list[Piece]]:
    """The sequence cut into sequences whose lengths are the powers of two that make up its length."""
    total, out, rest = sum(p[2] for p in seq), [], list(seq)
    while total:
        room = 1 << (total.bit_length() - 1)
        total -= room
        part: list[Piece] = []
        while room:
            i, s, n = rest.pop(0)
            if n > room:
                rest.insert(0, (i, s + room, n - room))
                n = room
            part.append((i, s, n))
            room -= n
        out.append(part)
    return out


def pack(docs: DataFrame, tokenizer_path: str, drop_space: bool = False, end_id: int = 1,
         max_tokens: int = MAX_TOKENS, max_segments: int = MAX_SEGMENTS, max_loss: int | None = None,
         prompt: str | None = None, keep_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, n_loss and,
    with ``keep_ids``, the piece's ids.

    ``prompt`` names a column whose tokens come before the text's and bear no
    loss; without it all tokens bear loss.
    """
    small_batches(docs.sparkSession)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                      *([F.col(prompt).cast("string").alias("prompt")] if prompt else []))

    def run(batches):
        enc = encoder(tokenizer_path, drop_space)
        part, count = TaskContext.get().partitionId(), 0
        for t in gathered(batches, BLOCK_BYTES):
            flat, bounds = with_end(*enc.encode(t["text"]), end_id)
            before = np.zeros(t.num_rows, np.int64)
            if prompt:
                head, at = enc.encode(t["prompt"])
                before = np.diff(at)
                both = [x for i in range(t.num_rows) for x in (head[at[i]:at[i + 1]], flat[bounds[i]:bounds[i + 1]])]
                flat, bounds = np.concatenate(both), bounds + at
            lengths = np.diff(bounds)
            rows: list[tuple] = []
            for k, seq in enumerate(pack_block(lengths, before, max_tokens, max_segments, max_loss)):
                offset = 0
                for i, s, n in seq:
                    rows.append((i, s, n, k, offset))
                    offset += n
            if not rows:
                continue
            i, s, n, k, offset = (np.array(x, np.int64) for x in zip(*rows))
            lo = bounds[i] + s
            ids = flat.astype("<u4", copy=False)
            crc = [zlib.crc32(ids[a:b]) for a, b in zip(lo.tolist(), (lo + n).tolist())]
            cols = [t["doc_id"].combine_chunks().take(pa.array(i)), pa.array(s), pa.array(n), pa.array(crc, pa.int64()),
                    pa.array(lengths[i]), pa.array((part << PARTITION_SHIFT) + count + k), pa.array(offset),
                    pa.array(np.maximum(0, s + n - np.maximum(s, before[i])))]
            count += int(k[-1]) + 1
            if keep_ids:
                ends = np.cumsum(n)
                take = np.repeat(lo - (ends - n), n) + np.arange(int(ends[-1]))
                cols.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()),
                                                     pa.array(flat[take].view(np.int32))))
            yield pa.RecordBatch.from_arrays(cols, names)
        give_back()

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "n_loss"] + ["ids"] * keep_ids
    return src.mapInArrow(run, ", ".join(f"{c} {'array<int>' if c == 'ids' else 'long'}" for c in names))
