import math

import numpy as np
import pytest

from weirwalk.llm.whitening import fit_whitening, jacobi_davidson, minres, op11_whitening, packed_vectors, whitened_embeddings


def test_minres_solves_symmetric_systems():
    random = np.random.default_rng(1)
    a = random.standard_normal((30, 30))
    a = a + a.T
    rhs = random.standard_normal((30, 4))
    rhs[:, 2] = 0
    x = minres(lambda v: a @ v, rhs, 60, 1e-12)
    assert np.abs(a @ x - rhs).max() < 1e-6 and not x[:, 2].any()


@pytest.mark.parametrize("spread", [lambda i: 1.0 / (1 + i), lambda i: 1 + 0.001 * i, lambda i: 10.0 ** -(i % 40), lambda i: 1.0 + (i < 3)])
def test_jacobi_davidson_finds_eigenpairs(spread):
    random = np.random.default_rng(2)
    turn = np.linalg.qr(random.standard_normal((120, 120)))[0]
    values = np.array([spread(i) for i in range(120)])
    a = (turn * values) @ turn.T
    found, vectors, residuals = jacobi_davidson(lambda v: a @ v, 120, 6)
    assert np.abs(found - np.sort(values)[::-1][:6]).max() < 1e-13 * values.max()
    assert residuals.max() < 1e-13 * values.max() and np.abs(vectors.T @ vectors - np.eye(6)).max() < 1e-13


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_query_against_dense_eigenvectors(spark, sf):
    rows = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    rows = [r for r in rows if r["embedding"] is not None and all(c is not None and math.isfinite(c) for c in r["embedding"])]
    ids = [r["vec_id"] for r in rows]
    x = np.floor(np.array([r["embedding"] for r in rows], float) * 1024).astype(np.int64) + 100000
    n, sums, mean = len(x), x.sum(axis=0), x.mean(axis=0)
    covariance = (x - mean).T @ (x - mean) / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:8], vectors[:, ::-1][:, :8]
    got = op11_whitening(spark, f"/root/testdata/{sf}").toPandas().sort_values(["vec_id", "component"])
    assert list(got["vec_id"]) == sorted(ids * 8) and set(got["component"]) == set(range(1, 9))
    order = np.argsort(ids)
    deviation = ((n * x - sums) ** 2).sum(axis=1)[order]
    assert list(got["deviation"]) == list(np.repeat(deviation, 8)) and set(got["n"]) == {n}
    wanted = ((x - mean) @ (vectors / np.sqrt(values)))[order]
    found = got["whitened"].to_numpy().reshape(-1, 8)
    wanted *= np.sign((wanted * found).sum(axis=0))
    assert np.abs(found - wanted).max() < 1e-9
    assert np.allclose(got["explained"].to_numpy()[:8], values / np.trace(covariance), rtol=1e-12)
    assert got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] < 1e-12


def test_residuals_are_rounding(spark, small_dir):
    fit = fit_whitening(packed_vectors(spark.read.parquet(f"{small_dir}/embeddings.parquet"), "vec_id", "embedding"))
    assert len(fit.values) == 8 and (fit.residuals < 64 * 2.3e-16 * fit.values[0]).all()


def test_odd_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 1.0]), (2, [0.25, -1.0]), (2, [0.25, -1.0]), (None, [0.0, 3.0]), (3, None), (4, []), (5, [1.0, None]), (6, [nan, 1.0]), (7, [inf, 0.0]), (8, [1.0]), (9, [1.0, 2.0, 3.0])]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "vec_id bigint, embedding array<float>, whitened string")
    got = whitened_embeddings(docs).collect()
    assert sorted((r["vec_id"], r["component"]) for r in got if r["vec_id"] is not None) == sorted((i, c) for i in (1, 2, 2) for c in (1, 2))
    assert len(got) == 8 and {r["n"] for r in got} == {4}
    x = np.floor(np.array([r[1] for r in rows[:4]]) * 1024) + 100000
    centred = x - x.mean(axis=0)
    assert sorted({r["deviation"] for r in got}) == sorted({int(((4 * v - x.sum(axis=0)) ** 2).sum()) for v in x})
    first = np.array([r["whitened"] for r in got if r["component"] == 1])
    assert np.isclose(np.square(first).sum() / 4, 1) and np.isclose(max(r["explained"] for r in got), np.linalg.eigvalsh(centred.T @ centred / 4)[-1] / np.square(centred).sum() * 4)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_without_spread_there_is_no_component(spark, rows):
    assert whitened_embeddings(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect() == []


def test_fewer_directions_than_components(spark):
    rows = [(i, [float(i), 2.0 * i, 0.0, float(i % 3)]) for i in range(20)]
    got = whitened_embeddings(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"))
    assert {r["component"] for r in got.collect()} == {1, 2}
