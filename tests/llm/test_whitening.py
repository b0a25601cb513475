import math
from fractions import Fraction

import numpy as np
import pytest

from hearthstream.llm.whitening import (
    Moments,
    clusters,
    eigenvectors,
    squared_deviations,
    whiten_vectors,
)

SCHEMA = "vec_id bigint, embedding array<double>, n bigint, component int, y binary, dim int, body string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, None, 3, "b") for i, v in rows], SCHEMA).repartition(3)


def usable(v):
    return bool(v) and all(c is not None and math.isfinite(c) for c in v)


def brute(rows, components=16):
    """Exact rational covariance of the distinct grid vectors, and double-precision eigenvectors."""
    grid = {i: tuple(math.floor(64 * c) + 1000000 for c in v) for i, v in rows if usable(v)}
    out = {}
    for dim in {len(x) for x in grid.values()}:
        fit = sorted({x for x in grid.values() if len(x) == dim})
        n = len(fit)
        s = [sum(x[j] for x in fit) for j in range(dim)]
        v = [[Fraction(sum((n * x[j] - s[j]) * (n * x[k] - s[k]) for x in fit), n**3) for k in range(dim)]
             for j in range(dim)]
        e, axes = np.linalg.eigh(np.array(v, float))
        e, axes = e[::-1], axes[:, ::-1]
        for i, x in grid.items():
            if len(x) != dim:
                continue
            d = [n * a - b for a, b in zip(x, s, strict=True)]
            for c in range(min(components, dim)):
                if e[c] > 1e-12 * e[0] and e[0] > 0:
                    out[i, c + 1] = (n, sum(a * a for a in d), (np.array(d, float) / n) @ axes[:, c] / math.sqrt(e[c]),
                                     e[c] / float(sum(v[j][j] for j in range(dim))))
    return out


def check(spark, rows):
    got = whiten_vectors(table(spark, rows))
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    found = got.collect()
    want = brute(rows)
    assert sorted((r.vec_id, r.component) for r in found) == sorted(want)
    signs = {}
    for r in found:
        n, deviation, white, explained = want[r.vec_id, r.component]
        assert (r.n, r.deviation) == (n, deviation)
        assert r.explained == pytest.approx(explained, rel=1e-9) and 0 <= r.identity_error < 1e-9
        if abs(white) > 1e-3:
            length = len(dict(rows)[r.vec_id])
            signs.setdefault((length, r.component), math.copysign(1, white * r.whitened))
        sign = signs.get((len(dict(rows)[r.vec_id]), r.component), 1)
        assert r.whitened == pytest.approx(sign * white, abs=1e-7)
    return found


def test_against_exact_covariance(spark):
    rng = np.random.default_rng(1)
    turn = np.linalg.qr(rng.normal(size=(20, 20)))[0]
    data = rng.normal(size=(300, 20)) * np.linspace(3, 0.2, 20) @ turn
    rows = [(i, v.tolist()) for i, v in enumerate(data)]
    n = len(rows)
    # Copies, copies on the grid, and rows to drop.
    rows += [(n, rows[0][1]), (n + 1, [math.floor(64 * c) / 64 for c in rows[1][1]])]
    rows += [(n + 2, None), (n + 3, []), (n + 4, [None] + [0.0] * 19), (n + 5, [float("nan")] * 20),
             (n + 6, [float("inf")] * 20), (n + 7, [1e300] * 20)]
    found = [r for r in rows if r[0] != n + 7]
    check(spark, found)
    assert whiten_vectors(table(spark, rows)).count() == 302 * 16


def test_lengths_apart_and_few_dimensions(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(size=3 + i % 2) * [5, 2, 1, 3][: 3 + i % 2]).tolist()) for i in range(60)]
    found = check(spark, rows)
    assert {r.n for r in found} == {30} and max(r.component for r in found) == 4


def test_one_vector_has_no_components_and_an_empty_table_no_rows(spark):
    assert whiten_vectors(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    assert whiten_vectors(table(spark, [])).count() == 0


def test_rows_without_id_and_repeats_stay(spark):
    rows = [(None, [1.0, 2.0]), (None, [1.0, 2.0]), (4, [3.0, 1.0]), (5, [0.0, 9.0])]
    got = whiten_vectors(table(spark, rows)).collect()
    assert sum(r.vec_id is None for r in got) == 4 and {r.n for r in got} == {3}


def test_clustered_eigenvalues():
    rng = np.random.default_rng(3)
    q = np.linalg.qr(rng.normal(size=(30, 30)))[0]
    for gap in (1e-3, 1e-6, 1e-9, 0.0):
        values = np.array([5.0] * 3 + [3.0] * 5 + [1.0] * 22) + gap * np.arange(30)[::-1]
        a = q * values @ q.T
        a = (a + a.T) / 2
        e, x = eigenvectors(a)
        assert np.abs(x.T @ x - np.eye(30)).max() < 1e-14
        assert np.abs(a @ x - x * e).max() < 1e-13
        assert np.abs(e - np.sort(np.linalg.eigvalsh(a))[::-1]).max() < 1e-13
        if gap >= 1e-6:  # far enough for the vectors themselves
            assert np.abs(np.abs((x * q[:, np.argsort(-values)]).sum(0)) - 1).max() < 1e-12
    assert [sorted(c.tolist()) for c in clusters(np.array([1.0, 5, 1.1, 9, 1.2]), 0.15)] == [[0, 2, 4]]


def test_large_numbers_stay_exact():
    y = np.array([[1 << 40, -3], [5, 7]], np.int64)
    n, sums = 10**9, [3, 4]
    want = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in y]
    assert squared_deviations(y, n, sums) == [v if v < 1 << 63 else None for v in want]


def test_moments_merge():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(50, 4)) + 9
    both = Moments.read((Moments.of(x[:7]) + Moments.of(x[7:])).bytes())
    off = x - x.mean(0)
    assert both.n == 50 and np.allclose(both.products, off.T @ off)
