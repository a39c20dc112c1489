"""Helpers shared by the training-data operators.

Row identity. Operators that send results back to their documents join on
``(_did, _tk)``: the doc_id (null stands as the smallest long) and a 64-bit
hash of the text. Both come from the row itself, so a recomputed task finds
the same rows; two rows with equal id and text share a key and get the same
result each.
"""
from __future__ import annotations

import contextlib
import ctypes
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.session import ensure_checkpoint_dir

NULL_ID = -(1 << 63)
KEY = ["_did", "_tk"]
# Arrow batches sent to Python workers: bounded in bytes, as single texts may be long.
ARROW_BATCH_BYTES = 8 << 20
ARROW_BATCH_ROWS = 2000
# Row groups of intermediate tables: a writer holds one in memory.
ROW_GROUP_BYTES = 16 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch brings into a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder that spark.checkpoint.dir names."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts lineage, survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def doc_key(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    return [F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_ID)).alias("_did"),
            F.xxhash64(F.col(text).cast("string")).alias("_tk")]


def free_name(df: DataFrame, base: str) -> str:
    """``base``, lengthened until ``df`` has no such column (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def utf8(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes; null is the empty text."""
    return [x.encode("utf-8") if x else b"" for x in column.to_pylist()]


def pieces(batches: Iterable[pa.RecordBatch], max_bytes: int) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of at most ``max_bytes`` of Arrow data (one row at least)."""
    for batch in batches:
        if batch.nbytes <= max_bytes or batch.num_rows <= 1:
            if batch.num_rows:
                yield batch
            continue
        step = max(1, batch.num_rows * max_bytes // batch.nbytes)
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def gathered(batches: Iterable[pa.RecordBatch], max_bytes: int) -> Iterator[pa.Table]:
    """The same rows in tables of about ``max_bytes`` of Arrow data, for work that pays by distinct word."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in pieces(batches, max_bytes):
        held.append(batch)
        size += batch.nbytes
        if size >= max_bytes:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def give_back() -> None:
    """Return freed memory to the system, at the end of a task: an idle Python worker keeps it otherwise."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):       # other C libraries keep what they have
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def whole_groups(batches: Iterable[pa.RecordBatch], key: str, max_bytes: int) -> Iterator[pa.Table]:
    """Tables in which no group of equal ``key`` is cut, from rows that come sorted by ``key``.

    A table holds about ``max_bytes``, or one group if that is larger; callers
    split groups that can grow with the data before they come here.
    """
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in pieces(batches, max_bytes):
        col = batch.column(batch.schema.get_field_index(key))
        if held and size >= max_bytes:
            # rows of the group that the held table ends in
            end = held[-1].column(held[-1].schema.get_field_index(key))[held[-1].num_rows - 1].as_py()
            same = 0
            while same < batch.num_rows and col[same].as_py() == end:
                same += 1
            if same < batch.num_rows:
                if same:
                    held.append(batch.slice(0, same))
                yield pa.Table.from_batches(held)
                held, size = [], 0
                batch = batch.slice(same)
        held.append(batch)
        size += batch.nbytes
    if held:
        yield pa.Table.from_batches(held)
