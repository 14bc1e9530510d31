"""Whitening against numpy's eigenvalues."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from periodledger.llm import queries, whitening


def spread(n, width, seed):
    return np.random.default_rng(seed).normal(size=(n, width)) * np.linspace(3, 0.3, width)


def check(got, kept, count):
    """``kept``: ids and vectors of the usable rows."""
    x = np.floor(np.array([v for _, v in kept], float) * 64).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(0)
    values, vectors = np.linalg.eigh(np.cov(fit.T, bias=True).reshape(x.shape[1], -1))
    values, vectors = values[::-1], vectors[:, ::-1]
    z = (x - fit.mean(0)) @ vectors[:, :count] / np.sqrt(values[:count])
    assert len(got) == len(kept) * count
    signs = {}
    wanted = sorted((repr(i), c + 1, round(abs(float(z[k, c])), 5), ((n * x[k] - sums) ** 2).sum().item()) for k, (i, _) in enumerate(kept) for c in range(count))
    assert sorted((repr(r.vec_id), r.component, round(abs(r.whitened), 5), r.deviation) for r in got) == wanted
    by_id = {i: k for k, (i, _) in enumerate(kept)}
    for r in got:
        if r.vec_id is not None and abs(r.whitened) > 1e-6:
            assert signs.setdefault(r.component, math.copysign(1, r.whitened * z[by_id[r.vec_id], r.component - 1])) == math.copysign(1, r.whitened * z[by_id[r.vec_id], r.component - 1])
        assert r.n == n and r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-9) and r.identity_error < 1e-8


def test_components(spark):
    rows = [(i, v.tolist()) for i, v in enumerate(spread(700, 24, 1))]
    rows += [(10_000 + i, rows[3][1]) for i in range(300)] + [(None, rows[5][1])]  # one hot vector
    odd = [(20_000, None), (20_001, []), (20_002, [None] + rows[0][1][1:]), (20_003, [math.nan] * 24), (20_004, [math.inf] + rows[0][1][1:]), (20_005, [1.0, 2.0])]
    made = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").repartition(13).withColumns({c: F.lit("clash") for c in ("n", "whitened", "component", "x", "width")})
    check(whitening.components(made).collect(), rows, 16)


@pytest.mark.parametrize("width", [1, 2, 5])
def test_few_dimensions(spark, width):
    rows = [(i, v.tolist()) for i, v in enumerate(spread(50, width, width))]
    check(whitening.components(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect(), [(i, np.float32(v)) for i, v in rows], width)


def test_whole_table(spark):
    dir_ = "/root/testdata/sf0.001"
    kept = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{dir_}/embeddings.parquet").collect()]
    check(queries.op13_whitening(spark, dir_).collect(), kept, 16)


def test_nothing_to_whiten(spark):
    schema = "vec_id long, embedding array<double>"
    for rows in ([], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        out = whitening.components(spark.createDataFrame(rows, schema))
        assert out.count() == 0 and out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_deficient_rank_and_far_entries(spark):
    # Two independent dimensions of three; a far entry keeps the sums exact.
    rows = [(i, [float(i % 7), float(i % 5), float(i % 7)]) for i in range(35)]
    got = whitening.components(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r.component for r in got} == {1, 2} and all(r.identity_error < 1e-9 for r in got)
    far = [(i, [float(i), 1e30 if i == 3 else -1e308]) for i in range(9)]
    got = whitening.components(spark.createDataFrame(far, "vec_id long, embedding array<double>")).collect()
    assert len(got) == 18 and all(r.deviation is None or r.deviation >= 0 for r in got)


@pytest.mark.parametrize("kind", ["random", "multiple", "near", "graded", "low rank", "identity", "one"])
def test_singular_values_and_directions(kind):
    rng = np.random.default_rng(5)
    turn = np.linalg.qr(rng.normal(size=(40, 40)))[0]
    back = np.linalg.qr(rng.normal(size=(40, 40)))[0]
    a = {"random": rng.normal(size=(300, 40)), "multiple": (turn * np.r_[np.full(20, 5.0), np.linspace(1, 2, 20)]) @ back, "near": (turn * np.r_[5, 5, 5 + 1e-9, np.linspace(1, 2, 37)]) @ back,
         "graded": (turn * np.logspace(0, -7, 40)) @ back, "low rank": rng.normal(size=(9, 40)), "identity": np.vstack([np.eye(40)] * 2), "one": rng.normal(size=(5, 1))}[kind]
    triangle = whitening._stack(np.empty((0, a.shape[1])), a)
    diagonal, above, v = whitening.bidiagonal(triangle)
    values = whitening.dqds(diagonal, above)
    wanted = np.linalg.svd(a, compute_uv=False) ** 2
    assert np.allclose(values[:len(wanted)], wanted, rtol=1e-9, atol=1e-18 * wanted[0])
    count = min(9, a.shape[1])
    z = v @ whitening.directions(diagonal, above, values, count)
    assert np.abs(z.T @ z - np.eye(count)).max() < 1e-11
    assert np.abs(a.T @ (a @ z) - z * values[:count]).max() < 1e-12 * values[0]


def test_blocks_do_not_matter(monkeypatch):
    a = spread(100, 6, 2)
    monkeypatch.setattr(whitening, "BLOCK", 7)
    small = whitening._stack(np.empty((0, 6)), a)
    assert np.allclose(small.T @ small, a.T @ a)
