"""Importance resampling against a plain recount (operator 12)."""
import hashlib
import math
import re
import zlib

import pytest

from ledgerflow.llm import common, importance
from llm_helpers import DOCS

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(low.encode("utf-8"))


def grams(text, orders):
    w = words(text)
    return [b" ".join(w[i:i + k]) for k in range(1, orders + 1) for i in range(len(w) - k + 1)]


def plain(docs, target, orders=1, buckets=10_000, percent=10, min_words=20, seed=2024):
    s, t = [0] * buckets, [0] * buckets
    for rows, c in ((docs, s), (target, t)):
        for _, text in rows:
            for g in grams(text, orders):
                c[zlib.crc32(g) % buckets] += 1
    S, T = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((b + 1) * (S + buckets) / ((a + 1) * (T + buckets)))) for a, b in zip(s, t)]
    out = []
    for doc_id, text in docs:
        g = grams(text, orders)
        weight = sum(gain[zlib.crc32(x) % buckets] for x in g)
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(text)) >= min_words])
    eligible = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    rank = {id(r): i + 1 for i, r in enumerate(eligible[:percent * len(eligible) // 100])}
    return sorted(([*r[:4], rank.get(id(r))] for r in out), key=str)


def rows_of(df):
    return sorted(([r.doc_id, r.n_features, r.weight, r.score, r.rank] for r in df.collect()), key=str)


@pytest.mark.parametrize("orders", [1, 2])
def test_whole_table(spark, small_docs, orders):
    docs, rows = small_docs
    bench = common.read_table(spark, "/root/testdata/sf0.001", "benchmark")
    target = [(r.item_id, r.text) for r in bench.collect()]
    assert rows_of(importance.ranked(docs, bench, orders=orders)) == plain(rows, target, orders)


def test_spans_of_overlapping_runs():
    line = importance.collapsed("\tIt's  a-B,\x00é9\n")
    assert line == "it s a b é9".encode()
    found = [line[a:b].decode() for a, b in importance.spans(line, [importance.gram_pattern(1), importance.gram_pattern(3)])]
    assert found == ["it", "s", "a", "b", "é9", "it s a", "s a b", "a b é9"]
    assert importance.collapsed(None) == b"" and importance.collapsed("?! ") == b""


def test_nulls_ties_repeats_and_long_texts(spark):
    long = "wide words " * 200_000
    rows = [(1, None), (2, ""), (3, "a b c " * 10), (3, "a b c " * 10), (None, "x y z " * 9), (5, "Été " * 25), (6, long), (7, "one two")]
    df = spark.createDataFrame([(*r, "en", "s", 0) for r in rows], DOCS).withColumnRenamed("source", "SCORE")
    target = spark.createDataFrame([(0, "a b"), (1, None)], "item_id long, text string")
    got = rows_of(importance.ranked(df, target, percent=50))
    assert got == plain(rows, [(0, "a b"), (1, None)], percent=50)
    drawn = importance.resample(df, target, percent=100)
    assert drawn.columns == df.columns
    assert sorted(str(r.doc_id) for r in drawn.collect()) == ["3", "3", "5", "6", "None"]


def test_empty_tables(spark):
    docs = spark.createDataFrame([], DOCS)
    target = spark.createDataFrame([], "item_id long, text string")
    assert importance.ranked(docs, target).collect() == []
    some = spark.createDataFrame([(1, "a b c", "en", "s", 5)], DOCS)
    r = importance.ranked(some, target, min_words=1, percent=100).collect()[0]
    assert (r.n_features, r.rank) == (3, 1)
