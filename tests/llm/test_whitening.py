"""Whitening against the library's eigenvectors and integers of Python."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from vaultwatch.llm import whitening as white

SCHEMA = "vec_id long, embedding array<float>, component string, x string"


def frame(spark, vectors, kind="float"):
    return spark.createDataFrame([(i, v, "clash", None) for i, v in vectors], SCHEMA.replace("float", kind))


def brute(vectors, most=16):
    """The rows that are judged, whole vectors, n, sums, and eigenvalues and vectors of the exact covariance."""
    good = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in vectors if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in good})
    n, dim = len(fit), len(fit[0])
    sums = [sum(x[j] for x in fit) for j in range(dim)]
    cov = np.array([[float(sum(Fraction(n * x[i] - sums[i]) * (n * x[j] - sums[j]) for x in fit) / n**3) for j in range(dim)] for i in range(dim)])
    values, q = np.linalg.eigh(cov)
    return good, n, sums, values[::-1][:most], q[:, ::-1][:, :most], float(np.trace(cov))


def check(spark, vectors, kind="float", most=16):
    good, n, sums, values, q, trace = brute(vectors, most)
    got = white.whiten(frame(spark, vectors, kind).repartition(3), most=most).collect()
    want = {}
    for i, x in good:
        off = np.array([float(Fraction(n * a - s, n)) for a, s in zip(x, sums)])
        for c, e in enumerate(values):
            want.setdefault((i, c + 1), []).append((sum((n * a - s) ** 2 for a, s in zip(x, sums)), off @ q[:, c] / math.sqrt(e), e / trace))
    assert sorted((r.vec_id, r.component) for r in got) == sorted(k for k, v in want.items() for _ in v)
    signs = {}
    for r in got:
        assert r.n == n and r.identity_error <= 1e-9
        options = want[r.vec_id, r.component]
        match = min(options, key=lambda o: abs(o[0] - r.deviation) + abs(abs(o[1]) - abs(r.whitened)))
        assert r.deviation == match[0]
        assert r.explained == pytest.approx(match[2], rel=1e-9)
        assert abs(r.whitened) == pytest.approx(abs(match[1]), abs=1e-7)
        if abs(r.whitened) > 1e-3:
            signs.setdefault(r.component, set()).add(r.whitened * match[1] > 0)
    assert all(len(s) == 1 for s in signs.values())


def test_same_as_the_library(spark):
    rnd = np.random.default_rng(1)
    base = rnd.normal(size=(200, 20)) * np.linspace(3, 0.2, 20)
    vectors = [(int(i), [float(np.float32(c)) for c in v]) for i, v in enumerate(base)]
    vectors += [(1000 + i, vectors[7][1]) for i in range(150)]  # one vector in many rows
    vectors += [(2000, None), (2001, []), (2002, [float("nan")] * 20), (2003, [float("inf")] + [0.0] * 19), (2004, [None] + [0.0] * 19)]
    vectors += [(5, vectors[9][1]), (None, vectors[3][1])]
    check(spark, [(i if i is not None else -1, v) for i, v in vectors])


def test_fewer_dimensions_than_components(spark):
    rnd = random.Random(2)
    check(spark, [(i, [rnd.uniform(-2, 2) for _ in range(3)]) for i in range(40)], "double", 3)


def test_large_entries_are_exact(spark):
    rnd = random.Random(3)
    check(spark, [(i, [rnd.uniform(-1, 1) + 1e9, rnd.uniform(-30, 30), rnd.uniform(-1, 1) - 1e12]) for i in range(30)], "double", 3)


@pytest.mark.parametrize("vectors", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_nothing_to_whiten(spark, vectors):
    df = white.whiten(frame(spark, vectors))
    assert df.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert df.collect() == []


def test_no_spread_in_some_directions_and_other_lengths(spark):
    rnd = random.Random(4)
    vectors = [(i, [rnd.uniform(-2, 2)] * 2 + [1.0]) for i in range(30)] + [(100, [1.0, 2.0])]
    got = white.whiten(frame(spark, vectors, "double")).collect()
    assert {r.component for r in got} == {1} and len(got) == 30
    assert got[0].explained == pytest.approx(1) and got[0].identity_error < 1e-9


def test_deviation_beyond_a_long_is_null(spark):
    got = white.whiten(frame(spark, [(1, [3e7]), (2, [-3e7]), (3, [0.0])], "double")).collect()
    assert {r.vec_id: r.deviation for r in got} == {1: None, 2: None, 3: 0}
    assert got[0].n == 3 and got[0].identity_error < 1e-9


def spectra():
    rnd = np.random.default_rng(5)
    yield np.linspace(1, 2, 40)
    yield 10.0 ** -np.arange(12)
    yield np.array([5.0] * 6 + [1.0] * 6 + [0.0] * 6)
    yield np.array([1, 1 + 1e-13, 1 + 1e-8, 2, 2 + 1e-14, 0, 1e-16, 3])
    yield np.ones(7)
    yield np.zeros(4)
    yield rnd.normal(size=64)
    yield np.array([1e12, 1, 1, 1e-3])


@pytest.mark.parametrize("values", list(spectra()), ids=range(8))
def test_spectral_divide_and_conquer(values):
    rnd = np.random.default_rng(6)
    basis, _ = np.linalg.qr(rnd.normal(size=(len(values),) * 2))
    a = (basis * values) @ basis.T
    a = (a + a.T) / 2
    found, q = white.eigen(a)
    size = np.linalg.norm(a) or 1
    assert np.all(np.diff(found) <= 0)
    assert np.abs(found - np.sort(values)[::-1]).max() <= 1e-13 * size
    assert np.abs(q.T @ q - np.eye(len(a))).max() <= 1e-13
    assert np.abs(a @ q - q * found).max() <= 2e-13 * size


def test_polar_factor():
    rnd = np.random.default_rng(7)
    a = rnd.normal(size=(30, 30))
    a = a + a.T
    values, q = np.linalg.eigh(a)
    assert np.abs(white.polar(a) - (q * np.sign(values)) @ q.T).max() < 1e-12
