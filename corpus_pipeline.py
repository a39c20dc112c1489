"""A training corpus from raw documents: five stages, each on all rows that the one before kept.

Every stage takes (spark, docs, sf_dir); its result is written as Parquet and
read again as the next stage's docs. All but the last keep the columns of
documents. ``run`` applies them to the documents of ``sf_dir``.
"""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm import decontaminate, divergence, line_dedup, packing, simhash
from ledgerflow.llm.common import read_table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the divergence rule (operator 5)."""
    return divergence.keep_natural(docs)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten or more of them share, but for the first of each (operator 8);
    n_chars follows the text. Without the first, a text with ten copies would vanish from all of them."""
    out = line_dedup.drop_repeated_lines(docs, keep_first=True).select(*docs.columns)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (operator 9)."""
    return simhash.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item (operator 7)."""
    return decontaminate.without_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences (operator 4)."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), keep_ids=False)


STAGES = [("quality_rules", quality_rules), ("line_dedup", drop_lines), ("simhash", drop_near_duplicates),
          ("decontaminate", drop_contaminated), ("packing", pack_sequences)]

# The tokenizer and the fingerprints' hash have no DuckDB function: the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = written(stage(spark, out, sf_dir), f"stage-{name}")
    return out
