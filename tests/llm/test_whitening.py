"""Whitening against a plain decomposition of the whole covariance (operator 13)."""
import math

import numpy as np
import pytest

from ledgerflow.llm import common, whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows):
    ok = [(i, [math.floor(64 * float(np.float32(c))) + 1000000 for c in v]) for i, v in rows
          if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in ok})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    z = np.array([[n * a - s for a, s in zip(x, sums)] for x in fit], float) / n
    cov = z.T @ z / n
    values, vectors = np.linalg.eigh(cov)
    return ok, n, sums, values[::-1], vectors[:, ::-1], np.trace(cov)


def compare(df, rows, components=16):
    ok, n, sums, values, vectors, trace = plain(rows)
    got = {}
    for r in whitening.whiten(df).collect():
        got.setdefault((r.vec_id, r.component), []).append(r)
    k = min(components, len(values))
    assert sum(map(len, got.values())) == len(ok) * k
    sign = {}
    for i, x in ok:
        z = [n * a - s for a, s in zip(x, sums)]
        for c in range(k):
            want = float(np.array(z, float) / n @ vectors[:, c]) / math.sqrt(values[c])
            r = got[i, c + 1][0]
            assert (r.n, r.deviation) == (n, sum(v * v for v in z))
            assert abs(r.explained - values[c] / trace) <= 1e-9 * values[c] / trace
            assert r.identity_error <= 1e-9
            if abs(want) > 1e-3:
                assert sign.setdefault(c, np.sign(want) * np.sign(r.whitened)) == np.sign(want) * np.sign(r.whitened)
            assert abs(abs(r.whitened) - abs(want)) <= 1e-7


def test_whole_table(spark):
    df = common.read_table(spark, "/root/testdata/sf0.001", "embeddings")
    compare(df, [(r.vec_id, r.embedding) for r in df.collect()])


def test_copies_nulls_and_bad_entries(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(c) for c in rng.normal(size=3)]) for i in range(30)]
    rows += [(100 + i, rows[0][1]) for i in range(40)]
    rows += [(200, None), (201, [1.0, None, 2.0]), (202, [1.0, float("nan"), 2.0]), (203, [float("inf"), 0.0, 0.0]), (None, rows[1][1])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    compare(df, rows)
    compare(df.withColumnRenamed("label", "N").repartition(7), rows)


def test_no_variance_other_lengths_and_empty(spark):
    same = spark.createDataFrame([(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0), (3, [1.0], 0), (4, [], 0)], SCHEMA)
    assert whitening.whiten(same).collect() == []
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    line = spark.createDataFrame([(i, [float(i), float(2 * i)], 0) for i in range(5)] + [(9, [7.0], 0)], SCHEMA)
    rows = whitening.whiten(line).collect()
    assert {r.component for r in rows} == {1} and {r.vec_id for r in rows} == set(range(5))


def test_deviation_beyond_a_long_is_null():
    z = whitening._numerators(np.array([[1 << 40, 0], [1, 2]]), 1 << 30, [0, 0])
    assert whitening._deviation(z) == [None, 5 << 60]
    assert whitening._deviation(whitening._numerators(np.array([[3, 4]]), 1, [0, 0])) == [25]


@pytest.mark.parametrize("dim", [1, 2, 7, 40])
def test_rank_one_updates(dim):
    rng = np.random.default_rng(dim)
    x = np.floor(rng.normal(size=(120, dim)) * 4)
    x[:, -1] = x[:, 0]                                  # equal directions, so that eigenvalues coincide
    x[60:90] = x[:30]
    a, b = whitening.Spectrum(dim), whitening.Spectrum(dim)
    for row in x[:50]:
        a.add(row)
    for row in x[50:]:
        b.add(row)
    a.merge(b.n, b.mean, b.lam, b.q)
    centred = x - x.mean(0)
    scatter = centred.T @ centred
    assert np.allclose(a.mean, x.mean(0)) and a.n == 120
    assert np.abs(a.q @ np.diag(a.lam) @ a.q.T - scatter).max() <= 1e-10 * np.abs(scatter).max()
    assert np.abs(a.q.T @ a.q - np.eye(dim)).max() <= 1e-12
