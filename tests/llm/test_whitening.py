"""Whitening against exact rational arithmetic."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from terrasync.llm import whitening

SCHEMA = "vec_id bigint, embedding array<double>, id string, v int, w int, part int"


def exact_covariance(rows):
    x = [[math.floor(1024 * c) + 100_000 for c in r] for r in rows]
    n, d = len(x), len(x[0])
    mean = [Fraction(sum(r[i] for r in x), n) for i in range(d)]
    y = [[r[i] - mean[i] for i in range(d)] for r in x]
    v = np.array([[float(sum(r[i] * r[j] for r in y) / n) for j in range(d)] for i in range(d)])
    s = [sum(r[i] for r in x) for i in range(d)]
    return v, np.array([[float(c) for c in r] for r in y]), [sum((n * r[i] - s[i]) ** 2 for i in range(d)) for r in x]


def table(spark, rows):
    return spark.createDataFrame([(i, v, "a", 1, 2, 3) for i, v in rows], SCHEMA)


@pytest.mark.parametrize("parts", [1, 7, 70])
def test_against_fractions(spark, parts):
    rng = np.random.default_rng(3)
    vectors = (rng.normal(size=(150, 10)) @ np.diag(np.geomspace(3, 0.05, 10)) + 2).tolist()
    bad = [(900, None), (901, [1.0] * 9 + [None]), (902, [math.nan] * 10), (903, [math.inf] + [0.0] * 9), (904, []), (905, [1.0, 2.0]), (906, [1e300] * 10)]
    found = whitening.whiten(table(spark, [*enumerate(vectors), *bad, (None, vectors[0]), (5, vectors[5])]).repartition(parts)).toPandas()
    rows = [*vectors, vectors[0], vectors[5]]
    v, y, deviations = exact_covariance(rows)
    e, u = np.linalg.eigh(v)
    want = (y @ u)[:, ::-1][:, :8] / np.sqrt(e[::-1][:8])
    assert len(found) == 8 * len(rows) and set(found.n) == {len(rows)} and found.identity_error.nunique() == 1 and found.identity_error[0] < 1e-9
    ids = [*range(150), None, 5]
    for k in range(8):
        got = found[found.component == k + 1]
        assert np.allclose(got.explained, e[::-1][k] / np.trace(v), rtol=1e-12)
        by = {i: (w, d) for i, w, d in zip(got.vec_id, got.whitened, got.deviation, strict=True) if i == i}
        sign = np.sign(by[0][0] * want[0, k])
        for i in range(150):
            assert by[i] == (pytest.approx(sign * want[i, k], rel=1e-9, abs=1e-9), deviations[i])
    assert sorted(map(str, found[found.component == 1].vec_id)) == sorted(str(float(i)) if i is not None else "nan" for i in ids)


def test_sums_of_products_are_double_double(spark):
    """A covariance of nearly equal large entries, exact to the last digits."""
    rng = random.Random(1)
    rows = [[2.0**30 + rng.randint(-3, 3) / 1024, 2.0**30 + rng.randint(-3, 3) / 1024, rng.random()] for _ in range(200)]
    exact, _, deviations = exact_covariance(rows)
    t = whitening.usable(table(spark, list(enumerate(rows))), "vec_id", "embedding")
    centre = whitening.Centre(*whitening.sums(t, 3))
    assert np.abs(whitening.covariance(t, 3, centre) / exact - 1).max() < 1e-15
    wide = whitening.Centre(centre.n, centre.s.tolist(), 1 << 61)
    assert not wide.narrow and np.abs(whitening.covariance(t, 3, wide) / exact - 1).max() < 1e-15
    x = np.array([[math.floor(1024 * c) + 100_000 for c in r] for r in rows])
    assert centre.deviation(x) == wide.deviation(x) == deviations


def test_transformations_are_error_free():
    rng = np.random.default_rng(0)
    a, b = rng.normal(size=500) * 10.0 ** rng.integers(-9, 9, 500), rng.normal(size=500)
    for f, g in ((whitening.two_sum, lambda x, y: x + y), (whitening.two_product, lambda x, y: x * y)):
        high, low = f(a, b)
        assert all(Fraction(h) + Fraction(m) == g(Fraction(x), Fraction(y)) for h, m, x, y in zip(high, low, a, b, strict=True))
    high, low = whitening.total((a, np.zeros(500)))
    assert float(abs(Fraction(float(high)) + Fraction(float(low)) - sum(map(Fraction, a)))) < 1e-25 * abs(a).max()


def test_blocks_of_the_triangle(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK", 4)
    monkeypatch.setattr(whitening, "MERGED", 2)
    rows = np.random.default_rng(5).normal(size=(40, 5)).tolist()
    t = whitening.usable(table(spark, list(enumerate(rows))).repartition(5), "vec_id", "embedding")
    assert np.allclose(whitening.covariance(t, 5, whitening.Centre(*whitening.sums(t, 5))), exact_covariance(rows)[0], rtol=1e-15)


def test_few_dimensions_and_none(spark):
    assert whitening.whiten(table(spark, [])).isEmpty()
    assert whitening.whiten(table(spark, [(1, None), (2, [])])).isEmpty()
    assert whitening.whiten(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).isEmpty()  # no spread at all
    flat = whitening.whiten(table(spark, [(i, [float(i), 2.0 * i, 0.5]) for i in range(9)])).toPandas()
    assert set(flat.component) == {1} and flat.explained[0] == pytest.approx(1) and flat.identity_error[0] < 1e-12
