"""Whitening: components against a dense eigensolver, exact whole numbers, and edges."""

import math
import random

import numpy as np
import pytest

from ledgerlake.llm.whitening import ZERO, Inertia, _cut, feast, leading, whiten


def matrix(kind, d, seed=1):
    rng = np.random.default_rng(seed)
    if kind == "spread":
        x = rng.standard_normal((500, d)) * np.linspace(1, 3, d)
    elif kind == "low rank":
        x = rng.standard_normal((500, 7)) @ rng.standard_normal((7, d))
    elif kind == "equal":
        x = np.vstack([np.eye(d), -np.eye(d)])
    elif kind == "steep":
        x = rng.standard_normal((500, d)) * 4.0 ** -np.arange(d)
    else:
        x = rng.standard_normal((50_000, d))
    x = x - x.mean(axis=0)
    return x.T @ x / len(x)


@pytest.mark.parametrize("kind", ["spread", "low rank", "equal", "steep", "dense"])
@pytest.mark.parametrize("d", [1, 5, 16, 17, 64])
def test_leading_pairs_are_those_of_a_dense_solver(kind, d):
    v = matrix(kind, d)
    pairs = leading(v, 16)
    known = np.linalg.eigvalsh(v)[::-1]
    k = len(pairs.values)
    assert k == min(16, int((known > ZERO * np.abs(v).sum(axis=1).max()).sum()))
    assert np.abs(pairs.values - known[:k]).max() < 1e-13 * known[0]
    assert np.abs(pairs.vectors.T @ pairs.vectors - np.eye(k)).max() < 1e-13
    assert np.abs(v @ pairs.vectors - pairs.vectors * pairs.values).max() < 1e-13 * known[0]


def test_inertia_counts():
    v = matrix("spread", 30)
    known = np.linalg.eigvalsh(v)
    inertia = Inertia(v)
    for shift in [0.0, *((known[1:] + known[:-1]) / 2), 2 * known[-1]]:
        assert inertia.above(shift) == (known > shift).sum()
    assert Inertia(np.array([[0.0, 1.0], [1.0, 0.0]])).above(0.0) == 1
    assert Inertia(np.zeros((3, 3))).above(0.0) == 0 and Inertia(np.zeros((3, 3))).above(-1.0) == 3
    assert Inertia(np.ones((1, 1))).above(0.5) == 1 and Inertia(np.diag([3.0, 1.0, 2.0])).above(1.5) == 2
    cut = _cut(inertia, 0.0, 2 * known[-1], 9, 9)
    assert (known > cut).sum() == 9 and min(abs(known - cut)) > 0.4 * (known[-9] - known[-10])
    widest = max(range(5, 10), key=lambda n: known[-n] - known[-n - 1])
    assert (known > _cut(inertia, 0.0, 2 * known[-1], 5, 9)).sum() == widest


def test_a_wrong_count_is_noticed():
    v = matrix("spread", 20)
    known = np.linalg.eigvalsh(v)
    with pytest.raises(ArithmeticError):
        feast(v, (known[-4] + known[-5]) / 2, 2 * known[-1], 5)


def by_hand(rows, most):
    kept = [(k, v) for k, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = {tuple(math.floor(64 * c) + 1_000_000 for c in v) for _, v in kept}
    n, sums = len(x), [sum(c) for c in zip(*x)]
    y = np.array([[n * c - s for c, s in zip(v, sums)] for v in x], dtype=float) / n
    cov = y.T @ y / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(most, int((values > 1e-12 * values[0]).sum()))
    out = {}
    for row, v in kept:
        z = [n * (math.floor(64 * c) + 1_000_000) - s for c, s in zip(v, sums)]
        out[row] = (n, sum(c * c for c in z), np.array(z, dtype=float) / n @ vectors[:, :k] / np.sqrt(values[:k]))
    return out, values[:k] / np.trace(cov)


def test_rows_equal_those_by_hand(spark):
    rng = random.Random(2)
    rows = [(k, [float(np.float32(rng.gauss(0, 0.2) * (d + 1))) for d in range(6)]) for k in range(300)]
    rows += [(300 + k, rows[0][1]) for k in range(100)]  # a hot vector counts once
    rows += [(900, None), (901, [None] * 6), (902, [float("nan")] + [0.0] * 5), (903, [float("inf")] + [0.0] * 5), (904, [0.0] * 6), (905, [])]
    data = spark.createDataFrame([(k, v, 1, "x") for k, v in rows], "vec_id long, embedding array<float>, n int, component string").repartition(5)
    known, explained = by_hand(rows, 4)
    found = whiten(data, 4).collect()
    assert len(found) == 4 * len(known) and {r.vec_id for r in found} == set(known)
    signs = {}
    for r in found:
        n, deviation, z = known[r.vec_id]
        assert r.n == n and int(r.deviation) == deviation
        sign = signs.setdefault(r.component, 1 if z[r.component - 1] * r.whitened > 0 else -1) if abs(r.whitened) > 1e-6 else 0
        assert not sign or abs(r.whitened - sign * z[r.component - 1]) < 1e-9
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-9 and r.identity_error < 1e-9
    assert len({r.identity_error for r in found}) == 1


def test_large_deviations_stay_exact(spark):
    rows = [(0, [3e12, 0.0]), (1, [-3e12, 1.0]), (2, [5.0, 7.0])]
    known, _ = by_hand(rows, 2)
    found = whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 2).collect()
    assert {r.vec_id: int(r.deviation) for r in found} == {k: v[1] for k, v in known.items()}


def test_edges(spark):
    kind = "vec_id string, embedding array<float>"
    assert whiten(spark.createDataFrame([], kind)).count() == 0
    assert whiten(spark.createDataFrame([("a", [1.0, 2.0])], kind)).count() == 0  # one vector has no variance
    assert whiten(spark.createDataFrame([(None, [1.0, 2.0]), ("b", [1.0, 5.0])], kind)).count() == 2
    with pytest.raises(ValueError, match="1 to 2"):
        whiten(spark.createDataFrame([("a", [1.0, 2.0]), ("b", [1.0])], kind))
