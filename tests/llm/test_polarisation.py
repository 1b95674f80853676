"""Whitening against plain whole-number arithmetic."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from periodgrid.llm import polarisation as P


def brute(vectors, components=32):
    """Rows of x, deviations, eigenvalues and covariance by the definition, in fractions."""
    xs = [[math.floor(64 * c) + 1000000 for c in v] for v in vectors]
    n, d = len(xs), len(xs[0])
    sums = [sum(x[i] for x in xs) for i in range(d)]
    y = [[n * x[i] - sums[i] for i in range(d)] for x in xs]
    cov = [[Fraction(sum(r[i] * r[j] for r in y), n ** 3) for j in range(d)] for i in range(d)]
    values = np.sort(np.linalg.eigvalsh(np.array(cov, float)))[::-1][:components]
    return y, [sum(a * a for a in r) for r in y], values, np.array(cov, float)


def rows_by_vector(df):
    found = {}
    for r in df.collect():
        found.setdefault(r.vec_id, {})[r.component] = r
    return found


@pytest.mark.parametrize("d,n,scale", [(1, 5, 1.0), (3, 40, 2.0), (40, 90, 0.3), (3, 30, 1e9)])
def test_against_fractions(spark, d, n, scale):
    rng = random.Random(d)
    base = [[rng.gauss(0, scale) for _ in range(d)] for _ in range(n)]
    vectors = [[float(sum(v[: i + 1])) for i in range(d)] for v in base]
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>").repartition(3)
    got = rows_by_vector(P.whitening_report(df))
    y, deviations, values, cov = brute(vectors)
    assert sorted(got) == list(range(n))
    w = np.array([[got[i][c].whitened for c in sorted(got[i])] for i in range(n)])
    assert w.shape[1] == min(d, 32)
    for i in range(n):
        want = deviations[i] if deviations[i] < 2 ** 63 else None
        assert all(r.deviation == want and r.n == n and r.identity_error < 1e-9 for r in got[i].values())
    explained = [got[0][c].explained for c in sorted(got[0])]
    assert np.allclose(explained, values / np.trace(cov), rtol=1e-9, atol=1e-15)
    assert np.allclose(w.T @ w / n - np.outer(w.mean(0), w.mean(0)), np.eye(w.shape[1]), atol=1e-9)
    # each component is an eigenvector: V a = e a, read back from the whitened values
    centred = np.array(y, float) / n
    axes = np.linalg.lstsq(centred, w * np.sqrt(values), rcond=None)[0]
    assert np.allclose(cov @ axes, axes * values, rtol=1e-6, atol=1e-6 * values[0])


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    data = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [0.0, 5.0]), (4, None), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, None]),
            (8, []), (9, [1.0]), (10, [2e17, 0.0]), (11, [-3.0, 0.5])]
    df = spark.createDataFrame([(i, v, "x", 0) for i, v in data], "vec_id long, embedding array<float>, v string, n int")
    rows = P.whitening_report(df).collect()
    assert sorted((r.vec_id or 0, r.component) for r in rows) == sorted([(1, 1), (1, 1), (1, 2), (1, 2), (0, 1), (0, 2), (11, 1), (11, 2)])
    assert {r.n for r in rows} == {4} and rows[0].identity_error < 1e-9
    empty = P.whitening_report(df.where("vec_id = 4"))
    assert empty.collect() == [] and empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_no_variance(spark):
    same = spark.createDataFrame([(i, [1.5, 2.5]) for i in range(3)], "vec_id long, embedding array<float>")
    assert {(r.deviation, r.whitened, r.explained, r.identity_error) for r in P.whitening_report(same).collect()} == {(0, None, None, None)}
    line = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(4)], "vec_id long, embedding array<float>")
    rows = rows_by_vector(P.whitening_report(line))
    assert rows[0][2].whitened is None and abs(rows[3][1].whitened) == pytest.approx(1.5 / math.sqrt(1.25))
    assert rows[0][1].explained == 1.0 and rows[0][1].identity_error < 1e-9


def test_long_entries_are_exact():
    big = 1 << 60
    z = np.array([[big, -big], [big, big - 1]], np.int64)
    assert P.squares(z) == {(0, 0): 2 * big * big, (0, 1): (2 * big - 1) ** 2, (1, 1): big * big + (big - 1) ** 2}
    assert P.column_sums(np.array([[2 ** 62 - 1]] * 4)) == {(0, 0): 2 ** 64 - 4}
