"""Whitening against a dense eigendecomposition."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderflow.llm.queries import LLM_QUERIES
from orderflow.llm.whitening import bidiagonalise, whiten

SF_DIR = "/root/testdata/sf0.001"


def dense(rows, components):
    """Centred rows, exact deviations, eigenvalues and vectors."""
    width = max((len(v) for _, v in rows), default=0)
    x = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in [*v, *[0.0] * (width - len(v))]] for _, v in rows], dtype=object)
    n = len(rows)
    exact = x * n - x.sum(axis=0)
    centred = (exact / n).astype(float)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    return centred, (exact**2).sum(axis=1), values[::-1][:components], vectors[:, ::-1][:, :components], values.sum()


def compare(got, rows, components, digits=1e-7):
    centred, deviations, values, vectors, total = dense(rows, components)
    by_row: dict = {}
    for r in got:
        assert r.n == len(rows) and r.identity_error <= 1e-8
        by_row.setdefault((r.vec_id, r.deviation), {})[r.component] = (r.whitened, r.explained)
    whitened = centred @ vectors / np.sqrt(values)
    for (i, _), deviation, want in zip(rows, deviations, whitened):
        own = by_row[i, int(deviation)]
        assert sorted(own) == list(range(1, len(values) + 1))
        for c, w in enumerate(want, 1):
            assert abs(abs(own[c][0]) - abs(w)) < digits
            assert abs(own[c][1] - values[c - 1] / total) < 1e-10 * own[c][1]


@pytest.mark.parametrize("width,components", [(5, 32), (40, 32), (1, 3)])
def test_against_eigenvectors(spark, width, components):
    rng = np.random.default_rng(width)
    scales = 1.5 ** -np.arange(width) * 4 if width < 20 else np.linspace(5, 1, width)
    rows = [(i, (rng.normal(size=width) * scales + 3).tolist()) for i in range(300)]
    rows += [(1, rows[1][1]), (None, rows[2][1])]
    bad = [(900, None), (901, [1.0, None]), (902, [float("nan")] * width), (903, [float("inf")] * width)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>").withColumn("x", F.lit("clash")).repartition(3)
    got = whiten(df.withColumn("n", F.lit("clash")), components).collect()
    assert len(got) == len(rows) * min(width, components)
    compare(got, rows, components)


def test_short_equal_and_absent_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    rows = [(i, [float(i % 3), float(i * i % 7)][: 1 + i % 2]) for i in range(20)] + [(50, [])]
    compare(whiten(spark.createDataFrame(rows, schema)).collect(), rows, 32)
    flat = spark.createDataFrame([(i, [1.0 * (i % 4), 2.0, 3.0]) for i in range(8)], schema)
    assert {r.component for r in whiten(flat).collect()} == {1}
    assert whiten(spark.createDataFrame([(i, [1.0, 2.0]) for i in range(3)], schema)).count() == 0
    assert whiten(flat.where("false")).count() == 0
    assert whiten(spark.createDataFrame([(1, [])], schema)).count() == 0


def test_large_entries_are_exact(spark):
    rows = [(i, [float((-1) ** i * 10.0**12 + i), float(i % 5) * 10.0**11]) for i in range(9)]
    got = whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    want = dict(zip(range(9), dense(rows, 2)[1]))
    assert all(r.deviation == (want[r.vec_id] if want[r.vec_id] < 1 << 63 else None) for r in got) and len(got) == 18


def test_repeated_and_absent_singular_values():
    rng = np.random.default_rng(1)
    left, right = (np.linalg.qr(rng.normal(size=s))[0] for s in ((50, 8), (8, 8)))
    for sigma in ([5, 5, 5, 2, 2, 1, 1, 1], [4, 3, 3, 1, 0, 0, 0, 0], [1] * 8):
        a = left * sigma @ right.T
        v, alphas, betas = bidiagonalise(8, lambda w, q: ((a @ w).T @ (a @ q), float((a @ q) @ (a @ q)), a.T @ (a @ q)), np.linalg.norm(a))
        b = np.diag(alphas) + np.diag(betas, 1)
        assert np.allclose(v.T @ v, np.eye(8), atol=1e-13)
        assert np.allclose(np.linalg.svd(b)[1], sigma, atol=1e-12)
        assert np.allclose(v @ b.T @ b @ v.T, a.T @ a, atol=1e-12)


def test_query_on_the_given_tables(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding").collect()]
    compare(LLM_QUERIES["op12_whitening"](spark, SF_DIR).collect(), rows, 32, 1e-6)
