"""Token ids in Parquet files that allow selective reads (operator 1).

``write_token_files`` encodes whole texts and writes one row per document in
ascending doc_id order: file by file, and within each file. Token ids are a
list column with dictionary encoding (ids repeat, so pages hold bit-packed
dictionary indexes); doc_id and n_tokens are delta-encoded (format version 2
without dictionaries). Row groups and pages have stated sizes, and the writer
adds column and offset indexes, so a reader can take the metadata columns
alone, or the pages of a doc_id range.

Defined cases: null text is the empty text, which has the end id only; a null
doc_id sorts first; rows with equal doc_id are ordered by a hash of their text
and each keeps its own row; an empty table gives no rows; further input columns are ignored.
"""
from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import gathered, small_batches
from ledgerflow.llm.encode import encoder

FILE_SCHEMA = "doc_id long, n_tokens int, ids array<int>"
ENCODE_BYTES = 12 << 20
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 2000


def with_end(flat: np.ndarray, bounds: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids with ``end_id`` behind each document, and the new bounds."""
    return np.insert(flat, bounds[1:], end_id), bounds + np.arange(len(bounds))


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, drop_space: bool = True,
                      end_id: int = 1, row_group_bytes: int = ROW_GROUP_BYTES,
                      page_bytes: int = PAGE_BYTES, page_rows: int = PAGE_ROWS) -> None:
    """Encode ``docs`` (doc_id, text) and write the token files to ``path``.

    The texts are range-partitioned by doc_id before they are encoded (the
    range sample reads them, but encodes nothing), so each task writes the
    file of its range and rows never meet in one place.
    """
    small_batches(docs.sparkSession)

    def encode(batches):
        enc = encoder(tokenizer_path, drop_space)
        for t in gathered(batches, ENCODE_BYTES):
            flat, bounds = with_end(*enc.encode(t["text"]), end_id)
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat.view(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [t["doc_id"].combine_chunks(), pa.array(np.diff(bounds), pa.int32()), lists], ["doc_id", "n_tokens", "ids"])

    # ranges by id and hash: the sample of keys that reaches the driver holds no texts
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
               .withColumn("tie", F.xxhash64("text"))
               .repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text").select("doc_id", "text"))
    (ordered.mapInArrow(encode, FILE_SCHEMA).write
     .option("compression", "zstd").option("parquet.writer.version", "PARQUET_2_0")
     .option("parquet.block.size", row_group_bytes).option("parquet.page.size", page_bytes)
     .option("parquet.page.row.count.limit", page_rows)
     .option("parquet.enable.dictionary#doc_id", "false").option("parquet.enable.dictionary#n_tokens", "false")
     .option("parquet.enable.dictionary#ids.list.element", "true")
     .parquet(path))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, n_tokens, ids, with the file's number ``_file`` and the row's place ``_row`` in it."""
    return (spark.read.schema(FILE_SCHEMA).parquet(path)
            .select("doc_id", "n_tokens", "ids",
                    F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).cast("int").alias("_file"),
                    F.col("_metadata.row_index").alias("_row")))


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """doc_id and n_tokens alone: the pages of ids are not read."""
    return spark.read.schema(FILE_SCHEMA).parquet(path).select("doc_id", "n_tokens")


def read_range(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """Rows of the ids ``first`` to ``last``: files and row groups outside the range are left out by their
    statistics, pages by the column index."""
    return spark.read.schema(FILE_SCHEMA).parquet(path).where(F.col("doc_id").between(first, last))


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 from the files.

    ``start`` adds up n_tokens: within a file in row order, and over whole
    files from a table with one row per file, which reads that column alone.
    """
    rows = read_token_files(spark, path)
    files = rows.groupBy("_file").agg(F.sum(F.col("n_tokens").cast("long")).alias("_sum"))
    before = files.select("_file", F.coalesce(
        F.sum("_sum").over(Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))

    def digest(batches):
        for b in batches:
            ids = b.column(2)
            flat = ids.flatten().to_numpy(zero_copy_only=False).astype("<u4")
            at = ids.offsets.to_numpy() - ids.offsets[0].as_py() if len(ids) else np.zeros(1, int)
            crc = [zlib.crc32(flat[i:j]) for i, j in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.diff(at), pa.int64()), pa.array(crc, pa.int64()), b.column(3), b.column(4)],
                ["doc_id", "n_tokens", "ids_crc32", "_file", "_row"])

    one = rows.mapInArrow(digest, "doc_id long, n_tokens long, ids_crc32 long, _file int, _row long")
    inside = Window.partitionBy("_file").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    return (one.withColumn("_in", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
            .join(before, "_file")
            .select("doc_id", (F.col("_before") + F.col("_in")).cast("long").alias("start"), "n_tokens", "ids_crc32"))
