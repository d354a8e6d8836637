import math

import numpy as np
import pytest

from smelter.llm import whitening as w
from smelter.llm.queries import op12_choleskyqr_whitening
from smelter.llm.whitening import cholesky, solve, whiten

SCHEMA = "vec_id long, embedding array<float>, label int, x int, n long, component string, length int, fine boolean"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, 1, 2, 3, "c", 4, True) for i, v in vectors], SCHEMA)


def brute(vectors, most=4):
    """vec_id -> (deviation, whitened by component), explained and n, by numpy's eigenvalues."""
    usable = [(i, v) for i, v in vectors if v and all(c is not None and math.isfinite(c) for c in v)]
    x = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in usable]
    fit = np.array(sorted({tuple(v) for _, v in x}), float)
    n, sums = len(fit), [sum(int(r[j]) for r in fit) for j in range(fit.shape[1])]
    centred = fit - fit.mean(axis=0)
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    values, directions = values[::-1][:most], directions[:, ::-1][:, :most]
    directions = directions * np.sign(directions[np.abs(directions).argmax(axis=0), range(directions.shape[1])])
    total = np.trace(centred.T @ centred / n)
    rows = [(i, sum((n * a - s) ** 2 for a, s in zip(v, sums)), (np.array(v) - fit.mean(axis=0)) @ directions / np.sqrt(np.maximum(values, 1e-300))) for i, v in x]
    return n, rows, values / total


def check(got, vectors):
    n, rows, explained = brute(vectors)
    found = sorted(((r.vec_id, r.deviation, r.component), r) for r in got.collect())
    wanted = sorted(((i, d, k + 1), v) for i, d, each in rows for k, v in enumerate(each))
    assert [k for k, _ in found] == [k for k, _ in wanted]
    for (_, r), (key, value) in zip(found, wanted):
        assert r.n == n
        assert r.explained == pytest.approx(explained[key[2] - 1], rel=1e-9, abs=1e-12)
        assert r.identity_error <= 1e-10
        if explained[key[2] - 1] > 1e-12:
            assert r.whitened == pytest.approx(value, rel=1e-8, abs=1e-8)
        else:
            assert r.whitened is None


def random_vectors(n, dims, seed, scale=None):
    rng = np.random.default_rng(seed)
    data = rng.standard_normal((n, dims)) * (scale if scale is not None else 1 + np.arange(dims))
    return [(i, [float(c) for c in row]) for i, row in enumerate(data)]


def test_equals_eigenvectors_with_copies_and_unusable_rows(spark):
    vectors = random_vectors(300, 6, 1)
    vectors += [(1000 + i, vectors[7][1]) for i in range(200)] + [vectors[3]]
    odd = [(1, None), (2, []), (3, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (4, [math.nan] * 6), (5, [math.inf] * 6), (6, [1.0] * 5), (7, [1e30] * 6)]
    check(whiten(table(spark, vectors + odd).repartition(3)), vectors)


@pytest.mark.parametrize("scale", [np.array([1e4, 1, 1e3, 30, 2]), np.array([1, 1, 1, 1, 0])])
def test_uneven_and_constant_columns(spark, scale):
    check(whiten(table(spark, random_vectors(200, 5, 2, scale))), random_vectors(200, 5, 2, scale))


def test_dependent_columns_and_fewer_rows_than_columns(spark):
    base = random_vectors(100, 3, 3, np.ones(3))
    whole = [(i, [round(c) for c in v]) for i, v in base]
    dependent = [(i, [float(c) for c in (*v, v[0] + v[1], 2 * v[2])]) for i, v in whole]
    check(whiten(table(spark, dependent)), dependent)
    few = random_vectors(3, 6, 4)
    check(whiten(table(spark, few)), few)


def test_one_vector_has_no_variance(spark):
    got = whiten(table(spark, [(1, [1.0, 2.0]), (None, [1.0, 2.0])])).collect()
    assert sorted((r.vec_id or 0, r.component) for r in got) == [(0, 1), (0, 2), (1, 1), (1, 2)]
    assert {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in got} == {(1, 0, None, 0.0, None)}


def test_tables_without_usable_rows(spark):
    assert whiten(table(spark, [])).collect() == whiten(table(spark, [(1, None), (2, [])])).collect() == []


def test_deviation_is_exact_or_null():
    centre = w.Centre(3, (1 << 40, 5))
    x = np.array([[1 << 30, 7], [-(1 << 30), 0]])
    assert centre.deviations(x) == [None, None]
    small = w.Centre(1 << 20, (1 << 30, 5))
    x = np.array([[1 << 10, 7], [0, 0]])
    assert small.deviations(x) == [sum(((1 << 20) * int(v) - s) ** 2 for v, s in zip(r, small.sums)) for r in x]


def test_factor_and_solve():
    rng = np.random.default_rng(5)
    a = rng.standard_normal((50, 4)) @ np.diag([1e4, 1, 1e-2, 1])
    r = cholesky(a.T @ a)
    q = solve(a, r)
    assert np.allclose(q @ r, a) and np.allclose(np.triu(r), r)
    a[:, 2] = a[:, 0] - a[:, 1]
    r = cholesky(a.T @ a)
    assert r[2, 2] == 0 and not solve(a, r)[:, 2].any()


def test_ill_conditioned_columns_become_orthonormal(spark):
    """Columns 1e9 apart in scale and nearly parallel: the covariance's own condition number is beyond a double."""
    rng = np.random.default_rng(6)
    x = rng.integers(-(10**9), 10**9, (400, 3))
    x = np.column_stack([x[:, 0], x[:, 0] + rng.integers(-1, 2, 400), x[:, 2]])
    fit = spark.createDataFrame([(r,) for r in x.tolist()], "x array<long>").distinct()
    centre = w.totals(fit, 3)
    r = w.factor(fit, 3, centre)
    exact = np.linalg.svd(centre.centred(x), compute_uv=False)
    assert np.allclose(np.linalg.svd(r, compute_uv=False), exact, rtol=1e-6)


def test_query_on_the_whole_table(spark):
    path = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
    check(op12_choleskyqr_whitening(spark, path), rows)
