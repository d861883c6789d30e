"""Whitening against one singular value decomposition of the whole centred list."""

import math
from fractions import Fraction

import numpy as np
import pytest

from ledgerscope.llm import whitening

NAN, INF = float("nan"), float("inf")


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3.0) for i, v in rows],
                                 "vec_id long, embedding array<float>, n long, component int, x double")


def brute(rows):
    """(rows kept, fit list n, sums, eigenvalues, eigenvectors, centred function)."""
    kept = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in rows
            if v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n = len(fit)
    sums = [sum(c) for c in zip(*fit)]
    centred = np.array([[float(Fraction(c * n - s, n)) for c, s in zip(x, sums)] for x in fit])
    _, spread, right = np.linalg.svd(centred, full_matrices=False)
    return kept, n, sums, spread ** 2 / n, right.T


def check(spark, rows, components=16):
    got = whitening.whiten(frame(spark, rows), components).collect()
    kept, n, sums, values, vectors = brute(rows)
    live = int((values > values[0] * 1e-24).sum()) if n > 1 and values[0] > 0 else 0
    k = min(components, live)
    assert len(got) == len(kept) * k
    trace = values.sum()
    by_row = {}
    for r in got:
        by_row.setdefault(r.vec_id, []).append(r)
        assert r.n == n and abs(r.explained / (values[r.component - 1] / trace) - 1) < 1e-4
        assert r.identity_error < 1e-4
    signs = {}
    for i, x in kept:
        own = by_row[i]
        exact = sum((n * c - s) ** 2 for c, s in zip(x, sums))
        d = np.array([float(Fraction(c * n - s, n)) for c, s in zip(x, sums)])
        for r in own:
            assert r.deviation == (exact if exact < 1 << 63 else None)
            want = float(d @ vectors[:, r.component - 1]) / math.sqrt(values[r.component - 1])
            if abs(want) > 1e-3:
                sign = signs.setdefault(r.component, np.sign(want * r.whitened))
                assert abs(sign * r.whitened - want) < 1e-4 * max(1, abs(want)), (i, r.component)
    return got


def random_rows(n, dims, seed, scale=None):
    rnd = np.random.default_rng(seed)
    scale = np.linspace(3, 0.3, dims) if scale is None else scale
    return [(i, (rnd.normal(size=dims) * scale + 0.5).astype(np.float32).tolist()) for i in range(n)]


def test_random_rows_with_repeats(spark):
    rows = random_rows(300, 20, 1)
    rows += [(1000 + i, rows[0][1]) for i in range(200)]  # a vector that holds a third of all rows
    check(spark, rows)


def test_dropped_rows_and_fewer_dimensions(spark):
    rows = random_rows(60, 5, 2)
    rows += [(500, None), (501, []), (502, [1.0, None, 1.0, 1.0, 1.0]), (503, [NAN] * 5), (504, [INF, 0.0, 0.0, 0.0, 0.0]),
             (505, [3e38, 0.0, 0.0, 0.0, 0.0])]
    got = whitening.whiten(frame(spark, rows + [(506, [1.0, 2.0])])).collect()
    assert {r.vec_id for r in got} == set(range(60)) and {r.component for r in got} == {1, 2, 3, 4, 5}
    check(spark, rows[:-1])


def test_wide_range_of_spreads(spark):
    rnd = np.random.default_rng(5)
    base = rnd.normal(size=(400, 6))
    wide = base * [1e6, 1e6, 1e3, 1.0, 1.0, 0.2]
    wide[:, 1] = wide[:, 0] + 0.05 * base[:, 1]  # nearly the same dimension: a condition number of some 1e7
    check(spark, [(i, v.tolist()) for i, v in enumerate(wide)])


def test_dimensions_without_spread(spark):
    rows = [(i, [*v, v[0], 7.0, 2 * v[1] + v[0]]) for i, v in random_rows(200, 4, 7)]
    rows = [(i, [round(c * 64) / 64 for c in v[:4]]) for i, v in rows]
    rows = [(i, [*v, v[0], 7.0, 2 * v[1] + v[0]]) for i, v in rows]
    got = check(spark, rows)
    assert {r.component for r in got} == {1, 2, 3, 4}


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_nothing_to_fit(spark, rows):
    assert whitening.whiten(frame(spark, rows)).collect() == []


def test_two_vectors(spark):
    got = check(spark, [(1, [1.0, 2.0]), (2, [3.0, 5.0]), (2, [3.0, 5.0])][:2])
    assert len(got) == 2 and sorted(round(r.whitened, 9) for r in got) == [-1.0, 1.0]


def test_deviation_beyond_a_long():
    fit = whitening.Fit(10 ** 9, [0, 0])
    assert fit.deviations(np.array([[5, 1], [1 << 20, 0]], np.int64)) == [26 * 10 ** 18 if 26 * 10 ** 18 < 1 << 63 else None,
                                                                          None]
    assert whitening.Fit(10 ** 8, [0, 0]).deviations(np.array([[5, 1], [1 << 39, 0]], np.int64)) == [26 * 10 ** 16, None]


def test_query(spark, small):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    got = check(spark, rows)
    flat = [x for r in sorted(whitening.op13_embedding_whitening(spark, small).collect()) for x in r]
    assert [x for r in sorted(got) for x in r] == pytest.approx(flat, rel=1e-6, abs=1e-6)
