"""The registered queries of the training-data operators and their DuckDB statements.

Each query applies its operator with production parameters to a whole table
and derives the contract's columns from the operator's results.
"""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerflow.llm import (chat_tree, decontaminate, divergence, hmm, importance, line_dedup, main_text, packing,
                            simhash, suffix_dedup, token_files, toxicity, whitening)
from ledgerflow.llm.common import read_table, scratch

WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.json"
CONTROL_TEXT = "\\### Assistant: </turn> ok"


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "tokens")
    token_files.write_token_files(read_table(spark, sf_dir, "documents"), path, public_tokenizers.path(WORD_BPE), drop_space=True)
    return token_files.token_index(spark, path)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.drop_repeats(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op3_chat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = read_table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    more = spark.createDataFrame([(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)], "conv_id long, turn long, role string, text string")
    tokenizer = public_tokenizers.path(BYTE_BPE)
    return chat_tree.read_conversations(spark, chat_tree.write_tree(given.unionByName(more), tokenizer), tokenizer)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), keep_ids=False)


def op5_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.quality(read_table(spark, sf_dir, "documents"))


def op6_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score(read_table(spark, sf_dir, "documents"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.drop_repeated_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return near.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op11_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(read_table(spark, sf_dir, "pages"))


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = importance.ranked(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", "n_features", "weight", "score", "rank")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_token_files, op2_suffix_dedup, op3_chat_tree, op4_packing, op5_divergence, op6_hmm, op7_decontaminate,
    op8_line_dedup, op9_simhash, op10_toxicity, op11_main_text, op12_importance, op13_whitening)} | {"pipeline": corpus_pipeline.run}

_EDGES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_CASE = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

ORACLE = {
    "op3_chat_tree": """
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
        e AS (
            SELECT *, 13 + length(role) + length(text) + (length(role || text) - length(replace(role || text, '\\', '')))
                + (length(role) - length(replace(role, chr(10), '')))
                + CAST((length(text) - length(replace(text, '</turn>', ''))) / 7 AS BIGINT)
                + CAST((length(role) - length(replace(role, '</turn>', ''))) / 7 AS BIGINT)
                + coalesce(list_sum(list_transform(regexp_extract_all(text, '#{3,}'), lambda x: length(x) - 2)), 0)
                + coalesce(list_sum(list_transform(regexp_extract_all(role, '#{3,}'), lambda x: length(x) - 2)), 0) AS chars
            FROM t)
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
            CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
            CAST(sum(chars) AS BIGINT) AS formatted_chars
        FROM e GROUP BY conv_id""",
    "op8_line_dedup": f"""
        WITH l AS (
            SELECT doc_id, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS k,
                unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents),
        c AS (SELECT *, translate(trim(line, {_EDGES}), {_CASE}) AS key FROM l),
        f AS (SELECT key FROM c WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (f.key IS NOT NULL) AS n_dropped,
            sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (f.key IS NULL), '')) AS kept_sha256
        FROM c LEFT JOIN f USING (key) GROUP BY doc_id""",
}
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
