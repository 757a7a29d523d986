from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pregame.llm import whitening


def exact(vectors, components=4):
    """Fit list, sums, eigenvectors and shares from the definition."""
    fit = sorted({tuple(v) for v in vectors})
    n, x = len(fit), np.array(fit, np.float64)
    sums = [sum(v[i] for v in fit) for i in range(len(fit[0]))]
    a = x - np.array([s / n for s in sums])
    cov = a.T @ a / n
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values)[:components]
    return n, sums, values[order], vectors[:, order].T, np.trace(cov)


def check(rows, table, tolerance=1e-8):
    """``rows`` (id, vector) against the result ``table``."""
    usable = [(i, [math.floor(256 * float(c)) for c in v]) for i, v in rows]
    n, sums, values, comps, trace = exact([v for _, v in usable])
    by = {}
    for r in table:
        by.setdefault(r.component, []).append(r)
    k = len(by)
    assert sorted(by) == list(range(1, k + 1)) and k == sum(values > 1e-9 * values[0])
    for c, got in by.items():
        key = lambda p: str(p)
        assert sorted((str(r.vec_id), r.deviation) for r in got) == sorted(
            (str(i), sum((n * a - s) ** 2 for a, s in zip(v, sums))) for i, v in usable)
        want = [((np.array(v) - np.array(sums) / n) @ comps[c - 1] / math.sqrt(values[c - 1]), str(i)) for i, v in usable]
        sign = np.sign(want[int(np.argmax([abs(w) for w, _ in want]))][0])
        top = max(want, key=lambda w: abs(w[0]))
        mine = max(got, key=lambda r: abs(r.whitened))
        flip = np.sign(mine.whitened) * sign
        assert abs(abs(top[0]) - abs(mine.whitened)) < tolerance * 10
        a = np.sort([r.whitened * flip for r in got])
        assert np.allclose(a, np.sort([w for w, _ in want]), atol=tolerance)
        assert {r.n for r in got} == {n}
        assert abs(got[0].explained / (values[c - 1] / trace) - 1) < 1e-9 and got[0].identity_error < 1e-9


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")


def test_given_table(given):
    check([(r.vec_id, r.embedding) for r in given.collect()], whitening.whiten(given).collect())


def make(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_odd_rows(spark):
    rng = np.random.default_rng(0)
    good = [(i, [float(np.float32(x)) for x in rng.normal(size=6) * [9, 5, 2, 1, 1, .5]]) for i in range(40)]
    good += [(100, good[3][1]), (None, good[4][1]), (101, good[3][1]), (100, good[3][1])]
    odd = [(200, None), (201, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (202, [float("nan")] * 6), (203, [float("inf")] + [0.0] * 5),
           (204, [1.0, 2.0]), (205, []), (206, [3e38] + [0.0] * 5)]
    table = make(spark, [(i, v, 1) for i, v in good + odd])
    check(good, whitening.whiten(table).collect())
    extra = table.select("*", *[F.lit(1).alias(c) for c in ("x", "component", "n", "rows", "data", "w")])
    assert whitening.whiten(extra.repartition(5)).count() == 4 * len(good)


@pytest.mark.parametrize("rows", [[], [[1.0, 2.0, 3.0]], [[1.0, 2.0, 3.0]] * 5])
def test_no_spread(spark, rows):
    assert whitening.whiten(make(spark, [(i, v, 0) for i, v in enumerate(rows)])).collect() == []


def test_low_rank(spark):
    rng = np.random.default_rng(1)
    basis = rng.integers(-3, 4, (2, 10))
    rows = [(i, [float(x) for x in rng.integers(-5, 6, 2) @ basis]) for i in range(60)]
    got = whitening.whiten(make(spark, [(i, v, 0) for i, v in rows])).collect()
    assert {r.component for r in got} == {1, 2}
    check(rows, got)


def test_equal_eigenvalues(spark):
    """A cross of unit vectors: every eigenvalue is there several times."""
    rows = []
    for i in range(12):
        for s in (1.0, -1.0):
            v = [0.0] * 12
            v[i] = s * (2.0 if i < 3 else 1.0)
            rows.append((len(rows), v, 0))
    got = whitening.whiten(make(spark, rows)).collect()
    shares = sorted({(r.component, round(r.explained, 9)) for r in got})
    big, small = 4 / (3 * 4 + 9), 1 / (3 * 4 + 9)
    assert [s for _, s in shares] == pytest.approx([big, big, big, small])
    assert got[0].identity_error < 1e-9


def test_wide_and_ill_scaled(spark):
    rng = np.random.default_rng(3)
    q, _ = np.linalg.qr(rng.normal(size=(40, 40)))
    rows = [(i, [float(np.float32(c)) for c in (rng.normal(size=40) * 10.0 ** -np.arange(0, 4, .1)) @ q * 50], 0) for i in range(400)]
    check([(i, v) for i, v, _ in rows], whitening.whiten(make(spark, rows)).collect(), 1e-7)


def test_large_numbers(spark):
    """Sums and deviations beyond a long: sums stay exact, deviations become null."""
    rows = [(0, [2.0 ** 54, 0.0], 0), (1, [-2.0 ** 54, 1.0], 0), (2, [2.0 ** 54, 3.0], 0), (3, [1.0, 1.0], 0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    made, error = whitening.fit(table, "embedding")
    assert made.sums == [256 * (2 ** 54) + 256, 256 * 5] and made.n == 4 and error < 1e-6
    assert {r.deviation for r in whitening.whiten(table).collect()} == {None}


def test_sums_as_a_tree(spark, given, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    monkeypatch.setattr(whitening, "TASK_BYTES", 20_000)
    check([(r.vec_id, r.embedding) for r in given.collect()], whitening.whiten(given.repartition(9)).collect())
