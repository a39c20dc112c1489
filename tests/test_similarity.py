"""The trigram join against all pairs, with its frequent grams taken in twos and threes."""
from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from ledgerflow.operators import similarity


def _grams(text):
    words, word = [], ""
    for c in text.lower() + " ":
        if c.isalnum():
            word += c
        elif word:
            words, word = [*words, f"  {word} "], ""
    return {w[i:i + 3] for w in words for i in range(len(w) - 2)}


def _expected(left, right, t):
    out = {}
    for i, a in left:
        for j, b in right:
            x, y = _grams(a), _grams(b)
            if x and y and len(x & y) / len(x | y) >= t:
                out[i, j] = round(len(x & y) / len(x | y), 9)
    return out


def _texts(seed, n, words):
    r = random.Random(seed)
    code = lambda k: "".join(r.choice("abc") for _ in range(k))
    return [(i, r.choice(words) + code(r.choice([0, 1, 2, 3, 6, 9]))) for i in range(n)] + [(n, ""), (n + 1, "a"), (n + 2, "a b c"), (n + 3, "-")]


@pytest.mark.parametrize(("threshold", "pairs", "keys"), [(0.3, 0, 1000), (0.3, 2, 1000), (0.3, 20, 1000), (0.3, 0, 0), (0.3, 0, 12), (0.1, 0, 1000), (0.8, 0, 1000)])
def test_join_equals_all_pairs(spark, monkeypatch, threshold, pairs, keys):
    monkeypatch.setattr(similarity, "PAIRS_A_ROW", pairs)
    monkeypatch.setattr(similarity, "KEYS_A_SET", keys)
    left, right = _texts(1, 150, ["emp ", "", "x "]), _texts(2, 150, ["building ", "emp", "", "a "])
    df = lambda rows, k: spark.createDataFrame(rows, f"{k} int, t string")
    got = similarity.similarity_join(df(left, "l"), "l", F.col("t"), df(right, "r"), "r", F.col("t"), threshold).collect()
    assert len(got) == len({(r.l, r.r) for r in got})
    assert {(r.l, r.r): round(r.similarity, 9) for r in got} == _expected(left, right, threshold)


def test_frequent_grams_join_few_rows(spark):
    """Six-letter codes behind a word on either side: no gram of a code may bring all its rows together."""
    codes = [f"{i:06d}".translate(str.maketrans("0123456789", "abcdefghij")) for i in range(0, 1_000_000, 250)]
    df = lambda word, k: spark.createDataFrame([(i, f"{word} {c}") for i, c in enumerate(codes)], f"{k} int, t string")
    keys, was = [], similarity._keys

    def seen(per, depth):
        keys.append(was(per, depth).persist())
        return keys[-1]

    similarity._keys = seen
    try:
        n = similarity.similarity_join(df("emp", "l"), "l", F.col("t"), df("building", "r"), "r", F.col("t")).count()
    finally:
        similarity._keys = was
    left, right = (k.groupBy("_k1", "_k2", "_k3").count() for k in keys)
    met = left.join(right.withColumnRenamed("count", "other"), ["_k1", "_k2", "_k3"]).agg(F.sum(F.col("count") * F.col("other"))).first()[0]
    assert n >= len(codes)
    assert met <= 2 * similarity.PAIRS_A_ROW * 2 * len(codes)     # 16 million pairs are possible
    for k in keys:
        k.unpersist()
