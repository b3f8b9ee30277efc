import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripweave.llm import queries, whitening

LAYOUT = "vec_id long, embedding array<float>, label int"


def plain(rows, components=16):
    """n, the exact deviation of each row, eigenvalues, vectors, sums and covariance, by NumPy's own solver."""
    grid = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in rows]
    distinct = sorted({tuple(x) for x in grid})
    n, sums = len(distinct), [sum(column) for column in zip(*distinct)]
    centred = np.array([[n * a - s for a, s in zip(x, sums)] for x in distinct], float) / n
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    deviations = [sum((n * a - s) ** 2 for a, s in zip(x, sums)) for x in grid]
    return n, grid, sums, deviations, values[::-1][:components], vectors[:, ::-1][:, :components], covariance


def compare(found, ids, rows, components=16):
    n, grid, sums, deviations, values, vectors, covariance = plain(rows, components)
    assert len(found) == len(rows) * len(values)
    got = {}
    for row in found:
        got.setdefault(row.vec_id, {})[row.component] = row
    # Signs are free, but the same for all rows.
    own = {key: np.array([[n * a - s for a, s in zip(x, sums)]], float) / n @ vectors / np.sqrt(values) for key, x in zip(ids, grid)}
    signs = np.ones(len(values))
    for k in range(len(values)):
        key = max(own, key=lambda i: abs(own[i][0, k]))
        signs[k] = np.sign(own[key][0, k] * got[key][k + 1].whitened)
    for key, deviation in zip(ids, deviations):
        for k in range(len(values)):
            row = got[key][k + 1]
            assert (row.n, row.deviation) == (n, deviation)
            assert row.whitened == pytest.approx(signs[k] * own[key][0, k], abs=1e-7)
            assert row.explained == pytest.approx(values[k] / np.trace(covariance), rel=1e-9)
            assert row.identity_error <= 1e-9


def test_query_equals_a_plain_eigensolver(spark, small):
    table = spark.read.parquet(f"{small}/embeddings.parquet").select("vec_id", "embedding").collect()
    found = queries.op11_feast_whitening(spark, small)
    assert dict(found.dtypes) == {
        "vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint",
        "whitened": "double", "explained": "double", "identity_error": "double",
    }
    compare(found.collect(), [r.vec_id for r in table], [r.embedding for r in table])


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [[0.5, -1.0, 2.0], [0.25, 3.0, -2.0], [1.5, 0.0, 0.125], [-0.0, 1.0, 1.0], [9.0, 9.0, -9.0]]
    rows = [(i, v, i % 2) for i, v in enumerate(good)]
    rows += [(2, good[2], 0), (None, good[1], None), (10, None, 1), (11, [], 1), (12, [1.0, None, 2.0], 1)]
    rows += [(13, [nan, 1.0, 1.0], 1), (14, [inf, 1.0, 1.0], 1), (15, [-inf, 1.0, 1.0], 1), (16, [1.0, 2.0], 1)]
    rows += [(17, [3e38, 1.0, 1.0], 1)]
    vectors = spark.createDataFrame(rows, LAYOUT).withColumns({n: F.lit("x") for n in ("id", "x", "n", "component", "whitened")})
    found = whitening.whiten(vectors).collect()
    assert sorted((r.vec_id is None, r.vec_id or 0, r.component) for r in found) == sorted(
        (key is None, key or 0, k) for key in (0, 1, 2, 2, 3, 4, None) for k in (1, 2, 3)
    )
    n, _, _, deviations, values, _, covariance = plain(good)
    assert {r.n for r in found} == {n} == {5}
    assert {r.vec_id: r.deviation for r in found if r.vec_id is not None} == dict(enumerate(deviations))
    assert {r.component: round(r.explained, 9) for r in found} == {
        k + 1: round(v / np.trace(covariance), 9) for k, v in enumerate(values)
    }


@pytest.mark.parametrize("rows", [[], [(1, None, 0)], [(1, [1.0, 2.0], 0)], [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 1)]])
def test_vectors_that_do_not_differ_give_no_rows(spark, rows):
    assert whitening.whiten(spark.createDataFrame(rows, LAYOUT)).collect() == []


def test_dimensions_without_variance_have_no_component(spark):
    rows = [(i, [float(i), 2.0 * i, 7.0], 0) for i in range(6)]
    found = whitening.whiten(spark.createDataFrame(rows, LAYOUT)).collect()
    assert {r.component for r in found} == {1} and found[0].explained == pytest.approx(1.0)
    assert np.var([r.whitened for r in found]) == pytest.approx(1.0)


def test_wide_values_stay_exact(spark):
    rows = [(1, [2.0**50, 1.0], 0), (2, [-(2.0**50), 3.0], 0), (3, [0.0, 5.0], 0)]
    found = {r.vec_id: r for r in whitening.whiten(spark.createDataFrame(rows, LAYOUT)).collect() if r.component == 1}
    assert found[1].deviation is None  # over 64 bits
    assert found[3].deviation == plain([r[1] for r in rows])[3][2]


SPECTRA = {
    "spread": np.random.default_rng(1).exponential(size=40),
    "one large": np.r_[1e9, np.linspace(1, 2, 39)],
    "equal ones": np.r_[np.full(20, 3.0), np.full(20, 1.0)],
    "steep": 10.0 ** -np.arange(40.0),
    "close pairs": np.repeat(np.arange(20.0, 0, -1), 2) + np.tile([1e-9, 0], 20),
    "few": np.array([3.0, 2.0, 1.0]),
}


@pytest.mark.parametrize("name", SPECTRA)
def test_leading_components_of_any_spectrum(spark, name):
    spectrum = np.sort(SPECTRA[name])[::-1]
    turn = np.linalg.qr(np.random.default_rng(2).standard_normal((len(spectrum),) * 2))[0]
    matrix = turn * spectrum @ turn.T
    matrix = (matrix + matrix.T) / 2
    values, vectors = whitening.leading(spark, matrix)
    least = len(spectrum) * np.finfo(float).eps * 64 * np.abs(matrix).sum(axis=1).max()
    wanted = spectrum[:16][spectrum[:16] > least]
    assert values == pytest.approx(wanted, abs=1e-13 * spectrum[0])
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-13
    assert np.abs(matrix @ vectors - vectors * values).max() < 1e-13 * spectrum[0] * len(spectrum)


def test_inertia_counts_signs():
    draw = np.random.default_rng(3)
    for size in (1, 2, 3, 10, 50):
        a = draw.standard_normal((size, size))
        a = a + a.T
        values = np.linalg.eigvalsh(a)
        assert whitening.inertia(a) == ((values < 0).sum(), 0, (values > 0).sum())
    assert whitening.inertia(np.array([[0.0, 2.0], [2.0, 0.0]])) == (1, 0, 1)
    assert whitening.inertia(np.diag([0.0, -1.0, 0.0, 5.0, 3.0])) == (1, 2, 2)


def test_a_contour_that_misses_one_is_an_error():
    matrix = np.diag([5.0, 4.0, 3.0, 2.0, 1.0])
    assert whitening.contour(matrix, whitening.Interval(2.5, 5.5, 3))[0] == pytest.approx([5, 4, 3])
    with pytest.raises(ArithmeticError, match="contour found others"):
        whitening.contour(matrix, whitening.Interval(2.5, 5.5, 4))
