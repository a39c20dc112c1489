"""Operators 1 and 4: exact ids, file order, packing limits."""
import glob
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from ledgerflow.llm import packing, token_files
from ledgerflow.llm.common import scratch
from ledgerflow.llm.encode import encoder

ODD = ["", None, " ", "\n", "a  b", " a", "a ", "a\n\nb", "x \n y", "a\tb c", "it's, ok.. don't. I'LL", "a b",
       "<|endoftext|> x<|endoftext|>", "ΑΣ Σ. İ, ß.", "3.14, 5.", "...a,", "\x1c a b", "word.\nword\n", "日本 語。", "a\x85b c",
       "ŉ a. ǰ ª º. µ", "́a b", "x" * 5000, "the " * 3000]


def plain_ids(tok, text):
    return tok.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name,drop", [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)])
def test_encoder_equals_library(tokenizers, small_docs, name, drop):
    path = tokenizers.path(name)
    tok = Tokenizer.from_file(path)
    texts = ODD + [t for _, t in small_docs[1]]
    flat, at = encoder(path, drop).encode(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        assert flat[at[i]:at[i + 1]].tolist() == plain_ids(tok, t), repr(t)[:80]


def test_token_files(spark, tokenizers):
    path = tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    rows = [(5, "Hello, world"), (None, "null id"), (2, None), (9, ""), (5, "second text of five"), (1, "the end.")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, ids string").repartition(3)
    out = scratch(spark, "t")
    token_files.write_token_files(df, out, path)
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in token_files.token_index(spark, out).collect())
    assert [g[1] for g in got] == [None, 1, 2, 5, 5, 9]
    at, want = 0, defaultdict(list)
    for d, t in rows:
        ids = plain_ids(tok, t) + [1]
        want[d].append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    for start, d, n, crc in got:
        assert start == at and (n, crc) in want[d]
        at += n


def test_token_files_properties_and_readers(spark, tokenizers):
    """Encodings, row groups and page indexes as stated; the readers take no more than they need."""
    path = tokenizers.path("word_bpe_49k.json")
    out = scratch(spark, "t").removeprefix("file://")
    docs = [(i // 2, f"word{i % 7} and more words of text number {i * 7919}, " * 40) for i in range(6000)] + [(300, "twice"), (300, "twice")]
    token_files.write_token_files(spark.createDataFrame(docs, "doc_id long, text string"), out, path, row_group_bytes=1 << 14, page_bytes=1 << 12, page_rows=50)
    files = [pq.ParquetFile(f) for f in sorted(glob.glob(f"{out}/*.parquet"))]
    meta = [f.metadata for f in files if f.metadata.num_rows]
    assert sum(m.num_rows for m in meta) == 6002 and max(m.num_row_groups for m in meta) > 1
    last = None
    for m in meta:
        for g in range(m.num_row_groups):
            ids, n, tokens = (m.row_group(g).column(c) for c in range(3))
            assert "DELTA_BINARY_PACKED" in ids.encodings and "DELTA_BINARY_PACKED" in n.encodings and not ids.has_dictionary_page
            assert tokens.has_dictionary_page and "RLE_DICTIONARY" in tokens.encodings and tokens.compression == "ZSTD"
            assert all(c.has_column_index and c.has_offset_index for c in (ids, n, tokens))
            assert last is None or ids.statistics.min >= last
            last = ids.statistics.max
    light = token_files.read_metadata(spark, out)
    assert "ids" not in re.search(r"ReadSchema: (.*)", light._jdf.queryExecution().toString())[1]
    assert light.count() == 6002 and light.agg({"n_tokens": "sum"}).first()[0] == token_files.token_index(spark, out).agg({"n_tokens": "sum"}).first()[0]
    some = token_files.read_range(spark, out, 290, 300)
    assert "GreaterThanOrEqual(doc_id,290)" in some._jdf.queryExecution().toString()
    assert sorted(r.doc_id for r in some.collect()) == sorted([*range(290, 301)] * 2 + [300, 300])


def test_token_files_empty(spark, tokenizers):
    out = scratch(spark, "t")
    token_files.write_token_files(spark.createDataFrame([], "doc_id long, text string"), out, tokenizers.path("word_bpe_49k.json"))
    assert token_files.token_index(spark, out).count() == 0


@pytest.mark.parametrize("n,limits", [(400, {}), (120, {"max_segments": 3}), (100, {"max_tokens": 64, "max_loss": 20}), (0, {}), (1, {})])
def test_pack_block(n, limits):
    rng = np.random.default_rng(n)
    size = np.minimum(20_000, rng.lognormal(6, 1.3, n).astype(int) + 1)
    prompt = (size * rng.random(n) * 0.5).astype(int) if limits else np.zeros(n, int)
    limit = limits.get("max_tokens", 2048)
    cover = defaultdict(list)
    for seq in packing.pack_block(size, prompt, **limits):
        total = sum(x[2] for x in seq)
        assert len(seq) <= limits.get("max_segments", packing.MAX_SEGMENTS)
        assert total == limit or total & (total - 1) == 0
        assert sum(max(0, s + k - max(s, prompt[i])) for i, s, k in seq) <= limits.get("max_loss", limit)
        for i, s, k in seq:
            cover[i].append((s, k))
    for i in range(n):
        at = 0
        for s, k in sorted(cover[i]):
            assert s == at
            at += k
        assert at == size[i]


def test_pack_whole_table(spark, tokenizers, small_docs):
    path = tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    rows = packing.pack(small_docs[0], path).collect()
    ids = {d: plain_ids(tok, t) + [1] for d, t in small_docs[1]}
    seqs, covered = defaultdict(list), defaultdict(int)
    for r in rows:
        part = ids[r.doc_id][r.start:r.start + r.length]
        assert r.ids == part and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
        covered[r.doc_id] += r.length
        seqs[r.sequence_id].append((r.offset, r.length))
    assert covered == {d: len(x) for d, x in ids.items()}
    for own in seqs.values():
        at = 0
        for o, n in sorted(own):
            assert o == at
            at += n
        assert at <= 2048
