from __future__ import annotations

import math
import random
from fractions import Fraction

import numpy as np

from tidemark.llm import queries, whitening

SF = "/root/testdata/sf0.001"


def usable(v):
    return v is not None and all(c is not None and math.isfinite(c) for c in v)


def compare(rows, got, components=16):
    """Against whole numbers and numpy's solver."""
    kept = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in rows if usable(v)]
    fit = np.array(sorted({tuple(x) for _, x in kept}), object)
    n, sums = len(fit), fit.sum(0)
    mean = [Fraction(int(s), n) for s in sums]
    centred = np.array([[float(c - m) for c, m in zip(x, mean)] for x in fit])
    covariance = centred.T @ centred / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(components, int((values > 1e-12 * values.sum()).sum()))
    assert len(got) == k * len(kept)
    want = {}
    for i, x in kept:
        want.setdefault(i, []).append((sum((n * c - int(s)) ** 2 for c, s in zip(x, sums)), [float(c - m) for c, m in zip(x, mean)]))
    signs = {}
    for r in got:
        assert r.n == n and r.deviation in [d for d, _ in want[r.vec_id]]
        y = next(y for d, y in want[r.vec_id] if d == r.deviation)
        value = float(np.dot(y, axes[:, r.component - 1]) / math.sqrt(values[r.component - 1]))
        assert abs(abs(value) - abs(r.whitened)) < 1e-6
        if abs(value) > 1e-3:
            assert signs.setdefault(r.component, value * r.whitened > 0) == (value * r.whitened > 0)
        assert abs(r.explained - values[r.component - 1] / values.sum()) < 1e-9
        assert 0 <= r.identity_error < 1e-9


def test_query_equals_plain_whitening(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    compare(rows, queries.op11_mixed_precision_whitening(spark, SF).collect())


def test_defined_cases(spark):
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-3, 3) * (j + 1) for j in range(5)]) for i in range(40)]
    rows += [(50, rows[0][1]), (50, rows[0][1]), (None, rows[1][1])]
    rows += [(60, None), (61, [1.0, None, 2.0, 3.0, 4.0]), (62, [float("nan")] * 5), (63, [float("inf"), 1.0, 1.0, 1.0, 1.0])]
    vectors = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id bigint, embedding array<double>, dim int")
    compare(rows, whitening.whiten(vectors).collect())
    other = spark.createDataFrame([(1, []), (2, [1.0, 2.0])], "vec_id bigint, embedding array<float>")
    assert whitening.whiten(other).count() == 0  # no entry, and no variance
    assert whitening.whiten(vectors.where("false")).count() == 0
    mixed = vectors.select("vec_id", "embedding").union(spark.createDataFrame([(7, [float(i), 1.0]) for i in range(9)], "vec_id bigint, embedding array<double>"))
    assert whitening.whiten(mixed).where("n = 9").count() == 9  # of two dimensions one is flat
    huge = spark.createDataFrame([(i, [float(i) * 2.0**50, float(i % 3)]) for i in range(6)], "vec_id bigint, embedding array<double>")
    got = whitening.whiten(huge).collect()
    assert {r.deviation for r in got} == {None} and all(r.identity_error < 1e-9 for r in got)


def test_clustered_eigenvalues():
    rng = np.random.default_rng(1)
    for d, apart in ((6, 1e-9), (30, 1e-10), (24, 0.0)):
        q = np.linalg.qr(rng.normal(size=(d, d)))[0].astype(np.longdouble)
        for _ in range(3):
            q = q + q @ (np.eye(d, dtype=np.longdouble) - q.T @ q) / 2
        values = np.repeat(np.arange(1, d // 3 + 1), 3)[:d].astype(np.longdouble)
        values = values + np.tile(np.arange(3), d // 3 + 1)[:d] * np.longdouble(apart)
        a = (q * values) @ q.T
        got, x = whitening.eigen((a + a.T) / 2)
        assert np.abs(np.sort(got) - np.sort(values)).max() < 1e-16 * d
        assert np.abs(x.T @ x - np.eye(d)).max() < 1e-17 * d
        assert np.abs(a @ x - x * got).max() < 1e-16 * d
        if apart:  # the vectors themselves, as far as the gaps tell
            true = q[:, np.argsort(-values)]
            assert np.abs(np.abs((true * x).sum(0)) - 1).max() < 1e-12


def test_exact_products():
    rng = np.random.default_rng(2)
    for most in (3, 1 << 20, 1 << 40):
        y = rng.integers(-most, most, (50, 4))
        wide = y.astype(object)
        assert (whitening.exact_products(y) == wide.T @ wide).all()
