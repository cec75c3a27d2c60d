"""Operator 13 against direct computation."""

import math
from fractions import Fraction

import numpy as np
import pytest

from editpulse.llm import whitening

LD = np.longdouble


def table(spark, rows):
    rows = [(i, v, 3, "x", 1.0) for i, v in rows]
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, component int, x string, n double")


def direct(rows, d):
    """``x`` of each usable row, the fit list, its sums and its covariance in extended precision."""
    ok = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = [(i, tuple(math.floor(64 * np.float64(np.float32(c))) + 1_000_000 for c in list(v) + [0.0] * (d - len(v)))) for i, v in ok]
    fit = sorted({v for _, v in x})
    sums = [sum(v[j] for v in fit) for j in range(d)]
    z = np.array([[LD(len(fit) * v[j] - sums[j]) / len(fit) for j in range(d)] for v in fit])
    return x, fit, sums, z.T @ z / len(fit)


def vectors(seed=1, n=300, d=20):
    r = np.random.default_rng(seed)
    a = r.normal(size=(n, d)) @ r.normal(size=(d, d)) * 0.3
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(a)]
    rows += [(1000 + i, rows[i % 7][1]) for i in range(80)]  # copies
    return rows + [(2000, None), (2001, [1.0, None] + [0.0] * (d - 2)), (2002, [float("nan")] + [0.0] * (d - 1)), (2003, [float("inf")] * d)]


def test_whitening_equals_direct_computation(spark):
    d, rows = 20, vectors()
    got = {}
    for r in whitening.whiten(table(spark, rows)).collect():
        got.setdefault(r.vec_id, {})[r.component] = r
    x, fit, sums, v = direct(rows, d)
    n = len(fit)
    assert set(got) == {i for i, _ in x} and n == 300 and all(sorted(g) == list(range(1, 17)) for g in got.values())
    e, u = np.linalg.eigh(v.astype(np.float64))
    e, u = e[::-1], u[:, ::-1]
    sign = None
    for i, a in x:
        assert {r.n for r in got[i].values()} == {n}
        assert {r.deviation for r in got[i].values()} == {sum((n * c - s) ** 2 for c, s in zip(a, sums))}
        want = np.array([float(Fraction(n * c - s, n)) for c, s in zip(a, sums)]) @ u[:, :16] / np.sqrt(e[:16])
        own = np.array([got[i][k].whitened for k in range(1, 17)])
        sign = np.sign(want * own) if sign is None else sign
        assert np.allclose(own, want * sign, rtol=0, atol=1e-9)
    r = got[0]
    assert all(abs(r[k].explained - e[k - 1] / np.trace(v)) < 1e-12 for k in r)
    w = np.array([[got[i][k].whitened for k in range(1, 17)] for i in {a: i for i, a in x}.values()])
    w = w - w.mean(axis=0)
    error = np.abs(w.T @ w / n - np.eye(16)).max()
    assert {g[1].identity_error for g in got.values()} == {r[1].identity_error} and r[1].identity_error < 1e-12 and error < 1e-12


@pytest.mark.parametrize("case", ["random", "clusters", "equal", "low rank", "near equal", "identity", "zero", "one"])
def test_refinement_reaches_extended_precision(case):
    r = np.random.default_rng(5)
    d = {"one": 1}.get(case, 48)
    q = np.linalg.qr(r.normal(size=(d, d)))[0].astype(LD)
    for _ in range(3):  # orthogonal to extended precision
        q = q + q @ (np.eye(d, dtype=LD) - q.T @ q) / 2
    e = {"random": r.uniform(0.1, 9, d), "clusters": 1 + np.repeat(np.arange(8), 6) + 1e-9 * r.uniform(0, 1, 48),
         "equal": np.repeat(np.arange(1, 9), 6), "low rank": np.append(r.uniform(1, 2, 10), np.zeros(38)),
         "near equal": 1 + 1e-13 * np.arange(48), "identity": np.ones(48), "zero": np.zeros(48), "one": [3.0]}[case]
    e = np.sort(np.asarray(e, np.float64).astype(LD))[::-1]
    v = (q * e) @ q.T
    v = (v + v.T) / 2
    values, x, steps = whitening.refined(v)
    top = max(float(np.abs(e).max()), 1e-300)
    assert np.abs(values - e).max() <= 1e-16 * top
    assert np.abs(x.T @ x - np.eye(d)).max() < 1e-16
    assert np.abs(v @ x - x * values).max() <= 1e-16 * top and steps < 20


def test_large_entries_are_summed_exactly():
    r = np.random.default_rng(2)
    z = r.integers(-(1 << 25), 1 << 25, (4096, 5))
    want = [[sum(int(a) * int(b) for a, b in zip(z[:, i], z[:, j])) for j in range(5)] for i in range(5)]
    assert whitening.gram(z).tolist() == want
    assert whitening.gram(z % 100).tolist() == [[sum(int(a) % 100 * (int(b) % 100) for a, b in zip(z[:, i], z[:, j])) for j in range(5)] for i in range(5)]


def test_deviation_beyond_64_bits_and_entries_beyond_the_limit(spark):
    rows = [(1, [1e30, 0.0]), (2, [-1e30, 0.0]), (3, [3e5, 1.0])]
    got = {r.vec_id: r for r in whitening.whiten(table(spark, rows)).where("component = 1").collect()}
    top = 1 << 24
    sums = top - top + top, 64
    assert got[1].deviation == (3 * top - sums[0]) ** 2 + 64 ** 2 and got[3].deviation == (3 * top - sums[0]) ** 2 + (3 * 64 - 64) ** 2
    model = whitening.Whitening(1 << 20, np.array([0, 0]), [])
    assert model.deviations(np.array([[1 << 24, 0], [1, 2]])) == [None, 5 << 40]


def test_ragged_repeated_null_ids_and_degenerate_tables(spark):
    one = whitening.whiten(table(spark, [(7, [1.0, 2.0]), (None, [1.0, 2.0])])).collect()
    assert sorted((str(r.vec_id), r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one) == sorted(
        (i, k, 1, 0, None, 0.0, 0.0) for i in ("7", "None") for k in (1, 2))
    rows = [(1, [1.0, 2.0, 0.0]), (2, [1.0, 2.0]), (3, []), (4, [0.5]), (4, [0.5]), (5, [3.0, 1.0, 0.0])]
    got = whitening.whiten(table(spark, rows)).collect()
    assert len(got) == 18 and {r.n for r in got} == {4}  # 1 and 2 are one vector
    assert {r.component for r in got if r.whitened is None} == {3}
    assert {(r.vec_id, r.deviation) for r in got if r.component == 1} == {(i, sum((4 * c - s) ** 2 for c, s in zip(a, direct(rows, 3)[2]))) for i, a in direct(rows, 3)[0]}
    assert whitening.whiten(table(spark, [(1, None), (2, [])])).count() == 0
    assert whitening.whiten(table(spark, rows).where("false")).count() == 0
