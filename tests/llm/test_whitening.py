"""Whitening against numpy's own eigenvectors and exact integers."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from pelagia.llm import whitening
from pelagia.llm.queries import op13_embedding_whitening

KIND = "vec_id long, embedding array<float>, label int"


def write(spark, tmp_path, rows):
    spark.createDataFrame(rows, KIND).repartition(3).write.parquet(str(tmp_path / "embeddings.parquet"))
    return str(tmp_path)


def check(rows, got, most=32):
    rows = [(i, v) for i, v, _ in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in rows], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    centred = np.array([[float(Fraction(int(a) * n - int(s), n)) for a, s in zip(r, sums, strict=True)] for r in x])
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(most, len(values), int((values > 1e-10 * np.trace(cov)).sum()))
    want = centred @ vectors[:, :k] / np.sqrt(values[:k])
    by_row = {}
    for r in got:
        by_row.setdefault(r.vec_id, {})[r.component] = r
    assert len(got) == n * k and {r.n for r in got} == {n}
    signs = {}
    for (i, _), w, v in zip(rows, want, x, strict=True):
        for c in range(k):
            r = by_row[i][c + 1]
            if c not in signs and abs(w[c]) > 0.3:
                signs[c] = np.sign(w[c] * r.whitened)
            assert abs(abs(r.whitened) - abs(w[c])) < 1e-6 * max(1, abs(w[c]))
            if c in signs and abs(w[c]) > 0.01:
                assert np.sign(w[c] * r.whitened) == signs[c]
            assert abs(r.explained / (values[c] / np.trace(cov)) - 1) < 1e-6
            assert r.deviation == sum((n * int(a) - int(s)) ** 2 for a, s in zip(v, sums, strict=True))
            assert r.identity_error < 1e-6


@pytest.mark.parametrize(("d", "n"), [(3, 40), (48, 300), (150, 700)])
def test_equals_numpy(spark, tmp_path, d, n):
    r = np.random.default_rng(d)
    data = r.standard_normal((n, d)) * np.geomspace(3, 0.3, d) + r.standard_normal(d)
    rows = [(i, [float(c) for c in v], 0) for i, v in enumerate(data)]
    rows += [(9001, None, 1), (9002, [None] * d, 1), (9003, [float("nan")] + [0.0] * (d - 1), 1), (9004, [float("-inf")] * d, None)]
    got = op13_embedding_whitening(spark, write(spark, tmp_path, rows)).collect()
    check(rows, got)


def test_query_over_a_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    check(rows, op13_embedding_whitening(spark, sf).collect())


def test_lobpcg_many_dimensions_and_ties():
    r = np.random.default_rng(5)
    q = np.linalg.qr(r.standard_normal((400, 400)))[0]
    values = np.concatenate([[9, 9, 5], np.linspace(4, 0.5, 397)])
    a = (q * values) @ q.T
    got, vectors, worst = whitening.lobpcg(lambda b: a @ b, 400, 32)
    assert np.allclose(got, values[:32], rtol=1e-10) and worst <= 1e-9
    assert np.abs(vectors.T @ vectors - np.eye(32)).max() < 1e-12
    assert np.linalg.norm(a @ vectors - vectors * got, axis=0).max() < 1e-9 * 9


def test_constant_single_empty_and_odd_rows(spark, tmp_path):
    kept = ("n", "whitened")
    for k, rows in enumerate([[(1, [1.0, 2.0], 0)] * 5, [(1, [1.0, 2.0], 0)], [], [(1, [], 0), (2, None, 0)]]):
        assert op13_embedding_whitening(spark, write(spark, tmp_path / str(k), rows)).count() == 0, kept
    odd = [(i, [float(i % 3), float(i % 2)], 0) for i in range(12)] + [(50, [1.0], 0), (None, [0.0, 0.0], 0), (3, [0.0, 0.0], 0)]
    got = op13_embedding_whitening(spark, write(spark, tmp_path / "odd", odd)).collect()
    assert len(got) == 2 * 14 and {r.n for r in got} == {14} and sum(r.vec_id is None for r in got) == 2


def test_clashing_columns_and_large_counts(spark):
    rows = spark.range(200).select("id", F.array(F.rand(1), F.rand(2), F.rand(3)).alias("embedding"), F.lit(1).alias("x"), F.lit(2).alias("row"), F.lit(3).alias("whitened"))
    vectors = whitening.integers(rows)
    model = whitening.fit(vectors, 2)
    out = whitening.whiten(vectors, model)
    assert out.select("row.*").columns == rows.columns and out.count() == 200
    model.n, model.sums = model.n * 10**9, model.sums * 10**9
    big = whitening.whiten(vectors, model).first()
    assert int(big.deviation) % 10**18 == 0 and big.deviation > 2**63
