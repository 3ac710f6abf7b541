import math

import numpy as np
import pytest

from orestrata.llm import feast, queries, whitening


def spectra():
    draw = np.random.default_rng(3)
    turned, _ = np.linalg.qr(draw.standard_normal((40, 40)))
    yield "spread", draw.standard_normal((40, 40)) * np.logspace(0, -5, 40)[:, None]
    yield "many times one value", turned @ np.diag([3.0] * 25 + [1.0] * 15)
    yield "low rank", turned @ np.diag([2.0, 1.0, 1.0] + [0.0] * 37)
    yield "one", np.array([[2.0]])
    yield "nought", np.zeros((4, 4))


@pytest.mark.parametrize("name, root", list(spectra()))
def test_feast_finds_the_greatest_eigenpairs(name, root):
    matrix = root @ root.T
    values, vectors = feast.greatest_eigenpairs(matrix, 32)
    true = np.linalg.eigvalsh(matrix)[::-1][:32]
    size = max(np.abs(matrix).max(), 1e-300)
    assert np.abs(values - true).max() <= 1e-13 * size * len(matrix)
    assert np.abs(matrix @ vectors - vectors * values).max() <= 1e-13 * size * len(matrix)
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() <= 1e-13


def test_inertia_counts_eigenvalues_below_a_shift():
    draw = np.random.default_rng(4)
    for _ in range(40):
        matrix = draw.standard_normal((12, 12))
        matrix += matrix.T
        for shift in (0.0, draw.normal()):
            assert feast.count_below(matrix, shift) == (np.linalg.eigvalsh(matrix) < shift).sum()
    assert feast.count_below(np.zeros((3, 3)), 0.0) == 0
    assert feast.negative_pivots(np.array([[0.0, 1.0], [1.0, 0.0]])) == 1


def test_intervals_hold_what_is_wanted():
    matrix = np.diag(np.arange(1.0, 21.0))
    parts = feast.intervals(matrix, 12)
    assert sum(count for *_, count in parts) >= 12 and parts == sorted(parts, reverse=True)
    for low, high, count in parts:
        assert sum(low <= x < high for x in range(1, 21)) == count


def brute(rows, components=32):
    """{(id, component): (n, deviation, whitened, explained)}; signs are free."""
    ids, x = [i for i, _ in rows], np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for _, v in rows])
    n, sums = len(x), x.sum(axis=0)
    deviation = [int(sum(int(d) ** 2 for d in n * row - sums)) for row in x]
    y = x - sums / n
    covariance = y.T @ y / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    out = {}
    for k, value in enumerate(values):
        if value > 1e-11 * values[0]:
            for i, d, w in zip(ids, deviation, y @ vectors[:, k] / math.sqrt(value)):
                out[i, k + 1] = (n, d, w, value / np.trace(covariance))
    return out


def agree(got, wanted):
    assert {(r.vec_id, r.component) for r in got} == wanted.keys()
    signs = {}
    for r in got:
        n, deviation, value, explained = wanted[r.vec_id, r.component]
        assert (r.n, r.deviation) == (n, deviation)
        assert r.explained == pytest.approx(explained, rel=1e-9)
        assert 0 <= r.identity_error <= 1e-9
        if abs(value) > 1e-6:
            assert signs.setdefault(r.component, math.copysign(1, value * r.whitened)) * r.whitened == pytest.approx(value, rel=1e-7, abs=1e-9)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_whole_table_equals_brute_force(spark, folder):
    data = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    rows = [(r.vec_id, r.embedding) for r in data if r.embedding and all(c is not None and math.isfinite(c) for c in r.embedding)]
    agree(queries.op13_whitening(spark, folder).collect(), brute(rows))


def test_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(k, [1.0 + k % 7, float(k * k % 5), -0.01 * k]) for k in range(30)]
    rows += [(30, [0.0, 0.0, 0.0]), (31, [2.0, 1.0, 0.5]), (32, [2.0, 1.0, 0.5])]
    odd = [(100, None), (101, []), (102, [1.0, None, 2.0]), (103, [nan, 1.0, 1.0]), (104, [inf, 1.0, 1.0]), (105, [1.0, 2.0])]
    schema = "vec_id long, embedding array<float>, n int, whitened string"
    data = spark.createDataFrame([(*r, 1, "x") for r in rows + odd], schema).repartition(3)
    wanted = brute([(i, np.float32(v)) for i, v in rows])
    agree(whitening.whiten(data).collect(), wanted)
    assert {r.component for r in whitening.whiten(data, components=2).collect()} == {1, 2}
    assert whitening.whiten(data.limit(0)).count() == 0
    one = spark.createDataFrame([(1, [1.0, 2.0]), (1, [1.0, 2.0])], "vec_id long, embedding array<double>")
    assert whitening.whiten(one).count() == 0
    unknown = spark.createDataFrame([(None, [1.0]), (None, [3.0])], "vec_id long, embedding array<double>")
    assert sorted(r.whitened for r in whitening.whiten(unknown).collect()) == pytest.approx([-1.0, 1.0])
