"""Chat formatting as prefix trees (operator 3).

Conversations that share their first turns share the nodes of a tree: a node
is a turn together with all turns before it. Nodes are laid out depth first in
one token stream, each once. A node carries its place in the stream, the
position id of its first token (tokens before it in its own conversation) and
the stretches of the stream that it may attend to: its ancestors, with
neighbouring stretches merged.

Template of a turn::

    ### <role>\\n<text></turn>\\n

Control strings inside texts are broken up by backslashes (``###`` becomes
``#\\##``, ``</turn>`` becomes ``<\\/turn>``, and a backslash is doubled), so
neither appears in an escaped text, and dropping each backslash in front of a
character restores it. Head, text and tail are encoded apart, so the loss mask
(the text of assistant turns) begins and ends at tokens.

How it is distributed: a node's key is the exclusive-or of two 64-bit hashes of
(place, role, text) over its turns, built in stretches of ``BLOCK`` turns and
then over stretches. Conversations are sorted by their path, the list of nodes
they take where the tree branches (range partitions, so equal conversations
spread over tasks); a node belongs to the first conversation that passes it.
Depth-first order is then (rank of that conversation, place of the turn).

Defined cases: null texts and roles are empty; a null conv_id is a
conversation of its own; rows of one conversation are ordered by turn (null
first), role and text, and repeated rows are turns of their own; an empty
table gives no rows; further columns are ignored.
"""
from __future__ import annotations

import hashlib
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import NULL_ID, gathered, scratch, small_batches, written
from ledgerflow.llm.encode import encoder

BLOCK = 256
ENCODE_BYTES = 8 << 20
LOSS_ROLE = "assistant"
_BREAK = re.compile(r"\\|#(?=##)|<(?=/turn>)")
_BREAK_ROLE = re.compile(r"\\|#(?=##)|<(?=/turn>)|\n")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"### ((?:\\.|[^\\\n])*)\n(.*)</turn>\n", re.DOTALL)


def escape(text: str) -> str:
    return _BREAK.sub(lambda m: "\\\\" if m[0] == "\\" else m[0] + "\\", text)


def escape_role(role: str) -> str:
    return _BREAK_ROLE.sub(lambda m: "\\" + m[0] if m[0] in "\\\n" else m[0] + "\\", role)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turn(role: str, text: str) -> tuple[str, str, str]:
    """Head, text and tail of a formatted turn."""
    return f"### {escape_role(role)}\n", escape(text), "</turn>\n"


def parse_turn(formatted: str) -> tuple[str, str]:
    role, text = _TURN.fullmatch(formatted).groups()
    return unescape(role), unescape(text)


class Tree(NamedTuple):
    """Where the output lies: ``nodes`` (start, length, position, depth, attend, loss_from, loss_to, ids)
    and ``paths`` (conv_id, k, start), one row for each turn of each conversation."""
    nodes: str
    paths: str


def _before(value: Column, part: list[str], order: str, agg) -> Column:
    return agg(value).over(Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1))


def _keyed_turns(conversations: DataFrame) -> DataFrame:
    """cid, k (place from 1), role, text, own hashes h1, h2 and prefix keys p1, p2."""
    turns = conversations.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(NULL_ID)).alias("cid"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    turns = turns.withColumn("block", F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(NULL_ID)).cast("long"))
    part = ["cid", "block"]
    turns = turns.withColumn("k0", F.row_number().over(Window.partitionBy(*part).orderBy(F.col("turn").asc_nulls_first(), "role", "text")))
    sizes = turns.groupBy(*part).agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.select(*part, F.coalesce(_before(F.col("n"), ["cid"], "block", F.sum), F.lit(0)).alias("off"))
    turns = turns.join(sizes, part).withColumn("k", F.col("off") + F.col("k0"))
    turns = turns.withColumns({"h1": F.xxhash64("k", "role", "text"), "h2": F.xxhash64(F.lit("turn"), "text", "role", "k")})
    upto = Window.partitionBy(*part).orderBy("k0").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    turns = turns.withColumns({"x1": F.bit_xor("h1").over(upto), "x2": F.bit_xor("h2").over(upto)})
    whole = turns.groupBy(*part).agg(F.bit_xor("h1").alias("b1"), F.bit_xor("h2").alias("b2"))
    whole = whole.select(*part, *[F.coalesce(_before(F.col(b), ["cid"], "block", F.bit_xor), F.lit(0).cast("long")).alias(b) for b in ("b1", "b2")])
    return turns.join(whole, part).select("cid", "k", "role", "text", "h1", "h2", F.col("x1").bitwiseXOR(F.col("b1")).alias("p1"),
                                          F.col("x2").bitwiseXOR(F.col("b2")).alias("p2"))


def _numbered(spark: SparkSession, path: str) -> DataFrame:
    """Rows of files written in order, with ``start``: the sum of ``length`` of all rows before."""
    rows = spark.read.parquet(path).select("*", F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).cast("int").alias("_file"),
                                           F.col("_metadata.row_index").alias("_row"))
    files = rows.groupBy("_file").agg(F.sum("length").alias("n"))
    files = files.select("_file", F.coalesce(
        F.sum("n").over(Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return (rows.withColumn("_in", F.coalesce(_before(F.col("length"), ["_file"], "_row", F.sum), F.lit(0)))
            .join(files, "_file").withColumn("start", F.col("_before") + F.col("_in")).drop("_file", "_row", "_before", "_in"))


def _walk(batches):
    """Turns sorted by conversation and place: adds position and the merged stretches of the turns before."""
    cid, position, attend = None, 0, []
    for b in batches:
        out = []
        for c, k, owner, rank, start, length in zip(*(x.to_pylist() for x in b.columns)):
            if c != cid:
                cid, position, attend = c, 0, []
            out.append((c, k, owner, rank, start, length, position, [list(x) for x in attend]))
            position += length
            if attend and attend[-1][1] == start:
                attend[-1] = (attend[-1][0], start + length)
            else:
                attend.append((start, start + length))
        if out:
            cols = list(zip(*out))
            yield pa.RecordBatch.from_arrays([*[pa.array(x, pa.int64()) for x in cols[:7]], pa.array(cols[7], pa.list_(pa.list_(pa.int64())))],
                                             ["cid", "k", "owner", "rank", "start", "length", "position", "attend"])


def write_tree(conversations: DataFrame, tokenizer_path: str, loss_role: str = LOSS_ROLE) -> Tree:
    """Format, merge and encode ``conversations`` (conv_id, turn, role, text); see ``Tree`` for the files."""
    spark = conversations.sparkSession
    small_batches(spark)
    turns = written(_keyed_turns(conversations), "turns")
    key = ["p1", "p2", "k"]
    nodes = turns.groupBy(*key).agg(F.first("h1").alias("h1"), F.first("h2").alias("h2"))
    parents = nodes.where(F.col("k") > 1).select(F.col("p1").bitwiseXOR(F.col("h1")).alias("q1"), F.col("p2").bitwiseXOR(F.col("h2")).alias("q2"), (F.col("k") - 1).alias("qk"))
    # tables of their own, here and below: both sides of a join are then plain exchanges, whose hot partitions Spark splits
    forks = written(parents.groupBy("q1", "q2", "qk").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select("q1", "q2", "qk"), "forks")
    # a first turn always branches; later ones where their parent has several children
    step = F.struct("k", "p1", "p2")
    first = turns.where(F.col("k") == 1).select("cid", step.alias("s"))
    later = (turns.where(F.col("k") > 1)
             .select("cid", step.alias("s"), F.col("p1").bitwiseXOR(F.col("h1")).alias("q1"), F.col("p2").bitwiseXOR(F.col("h2")).alias("q2"), (F.col("k") - 1).alias("qk"))
             .join(forks, ["q1", "q2", "qk"]).select("cid", "s"))
    path = first.unionByName(later).groupBy("cid").agg(F.array_sort(F.collect_list("s")).alias("path"))
    size = turns.groupBy("cid").agg(F.max("k").alias("turns"))
    ranks = written(path.join(size, "cid").orderBy("path", "turns", "cid").select("cid", F.monotonically_increasing_id().alias("rank")), "ranks")
    ranked = turns.select("cid", "k", "p1", "p2", "role", "text").join(ranks, "cid")
    owners = written(ranked.groupBy(*key).agg(F.min("rank").alias("owner")), "owners")
    placed = written(ranked.join(owners, key).select("cid", "rank", "k", "owner", "role", "text"), "placed")

    def encode(batches):
        enc = encoder(tokenizer_path, drop_space=False, plain_specials=True)
        for t in gathered(batches, ENCODE_BYTES):
            roles = t["role"].to_pylist()
            parts = [format_turn(r, x) for r, x in zip(roles, t["text"].to_pylist())]
            flat, bounds = enc.encode(pa.array([p for own in parts for p in own], pa.string()))
            ends = bounds[::3]
            loss = np.array([r == loss_role for r in roles], bool)
            lo = bounds[1::3] - ends[:-1]
            hi = bounds[2::3] - ends[:-1]
            yield pa.RecordBatch.from_arrays(
                [t["owner"].combine_chunks(), t["k"].combine_chunks(), pa.array(np.diff(ends)), pa.array(np.where(loss, lo, 0)),
                 pa.array(np.where(loss, hi, 0)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view(np.int32)))],
                ["owner", "k", "length", "loss_from", "loss_to", "ids"])

    stream = scratch(spark, "stream")
    (placed.where(F.col("rank") == F.col("owner")).select("owner", "k", "role", "text")
     .repartitionByRange("owner", "k").sortWithinPartitions("owner", "k")
     .mapInArrow(encode, "owner long, k long, length long, loss_from long, loss_to long, ids array<int>").write.parquet(stream))
    laid = _numbered(spark, stream)
    walked = (placed.select("cid", "k", "owner", "rank").join(laid.select("owner", "k", "start", "length"), ["owner", "k"])
              .select("cid", "k", "owner", "rank", "start", "length").repartition("cid").sortWithinPartitions("cid", "k")
              .mapInArrow(_walk, "cid long, k long, owner long, rank long, start long, length long, position long, attend array<array<long>>"))
    walked = written(walked, "walked")
    out = Tree(scratch(spark, "nodes"), scratch(spark, "paths"))
    conv_id = F.when(F.col("cid") != NULL_ID, F.col("cid")).alias("conv_id")
    walked.select(conv_id, "k", "start").write.parquet(out.paths)
    own = walked.where(F.col("rank") == F.col("owner")).select("owner", "k", "position", "attend")
    (laid.join(own, ["owner", "k"]).select("start", "length", "position", F.col("k").alias("depth"), "attend", "loss_from", "loss_to", "ids")
     .repartitionByRange("start").sortWithinPartitions("start").write.parquet(out.nodes))
    return out


def read_conversations(spark: SparkSession, tree: Tree, tokenizer_path: str) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars, from the files alone."""
    nodes = spark.read.parquet(tree.nodes).select("start", "loss_from", "loss_to", "ids")
    paths = spark.read.parquet(tree.paths)
    rows = (paths.join(nodes, "start").select(F.coalesce("conv_id", F.lit(NULL_ID)).alias("cid"), "k", "loss_from", "loss_to", "ids")
            .repartition("cid").sortWithinPartitions("cid", "k"))

    def digest(batches):
        table = byte_table(tokenizer_path)
        text_of = lambda ids: b"".join(map(table.__getitem__, ids)).decode("utf-8")
        state, out = None, []

        def close():
            cid, n, turns, chars, loss, total = state
            out.append((None if cid == NULL_ID else cid, n, turns.hexdigest(), chars, loss.hexdigest(), total))

        def emit():
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                              ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for b in batches:
            for cid, _, lo, hi, ids in zip(*(x.to_pylist() for x in b.columns)):
                if state is None or state[0] != cid:
                    if state is not None:
                        close()
                    state = [cid, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                formatted = text_of(ids)
                role, text = parse_turn(formatted)
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode("utf-8"))
                state[5] += len(formatted)
                if hi > lo:
                    part = unescape(text_of(ids[lo:hi]))
                    state[3] += len(part)
                    state[4].update(part.encode("utf-8"))
            if out:
                yield emit()
                out.clear()
        if state is not None:
            close()
            yield emit()

    return rows.mapInArrow(digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


_TABLES: dict[str, list[bytes]] = {}


def byte_table(tokenizer_path: str) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary."""
    if tokenizer_path not in _TABLES:
        enc = encoder(tokenizer_path, drop_space=False, plain_specials=True)
        back = {ord(c): b for b, c in enc.letters.items()}
        vocab = enc.tok.get_vocab(with_added_tokens=False)
        table = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            table[i] = bytes(back.get(ord(c), ord(c)) for c in token)
        _TABLES[tokenizer_path] = table
    return _TABLES[tokenizer_path]
