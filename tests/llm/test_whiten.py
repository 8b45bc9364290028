import math

import numpy as np
import pytest

import __spark_entry__ as driver
from wattloom.llm import whiten

SCHEMA = "vec_id long, embedding array<double>, n int, _x string"


def brute(rows, components=4, scale=256):
    """{vec_id: [(n, deviation, whitened, explained) by component]} of rows with usable vectors."""
    usable = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max((len(v) for _, v in usable), default=0)
    xs = [(i, tuple(math.floor(scale * c) for c in v) + (0,) * (width - len(v))) for i, v in usable]
    fit = sorted({x for _, x in xs})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[c - s / n for c, s in zip(x, sums)] for x in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = []
    for i, x in xs:
        y = np.array([c - s / n for c, s in zip(x, sums)])
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums))
        for k in range(min(components, width)):
            out.append((i, k + 1, n, deviation, y @ vectors[:, k] / math.sqrt(values[k]), values[k] / values.sum()))
    return out


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA).repartition(5)
    return whiten.whitened(df, **options).collect()


def check(found, expected, tolerance=1e-8):
    order = lambda r: (r[0] is None, r[0], r[1], abs(r[4]))
    found, expected = sorted((tuple(r) for r in found), key=order), sorted(expected, key=order)
    assert [r[:4] for r in found] == [r[:4] for r in expected]
    signs = {}
    for (*_, a, b, error), (_, k, _, _, x, y) in zip(found, expected):
        assert abs(abs(a) - abs(x)) < tolerance * max(1, abs(x)) and abs(b - y) < 1e-9 and error < 1e-9
        if abs(x) > 1e-6:
            assert signs.setdefault(k, np.sign(a * x)) == np.sign(a * x)


def test_equals_eigenvectors(spark, monkeypatch):
    monkeypatch.setattr(whiten, "QR_ROWS", 16)
    monkeypatch.setattr(whiten, "FAN_IN", 2)
    rng = np.random.default_rng(2)
    x = (rng.normal(size=(300, 9)) * [3, 2, 1.5, 1.2, 1, 0.5, 0.1, 0.02, 0]).tolist()
    nan = float("nan")
    rows = list(enumerate(x)) + [(7, x[7]), (301, x[9]), (302, None), (303, [nan] * 9), (304, [None] * 9), (None, x[3])]
    found = run(spark, rows)
    check(found, brute(rows))
    check(run(spark, rows, components=2, scale=1024), brute(rows, 2, 1024))


def test_triangles_of_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(whiten, "FAN_IN", 2)
    x = np.random.default_rng(3).integers(-90, 90, (50, 6))
    rows = spark.createDataFrame([(r.tolist(),) for r in x], "_x array<long>").repartition(11)
    means = x.mean(axis=0)
    r = whiten._triangle(rows, means)
    assert np.abs(r.T @ r - (x - means).T @ (x - means)).max() < 1e-9


def test_short_vectors_are_filled_up(spark):
    rows = [(1, [1.0, 2.0, 5.0]), (2, [3.0]), (3, [0.5, 0.0]), (4, [9.0, -1.0, 2.0]), (5, []), (6, [2.0, 2.5, -3.0])]
    check(run(spark, rows), brute(rows))


def test_no_variance(spark):
    found = run(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])
    assert {tuple(r) for r in found} == {(i, k, 1, 0, None, 0.0, 0.0) for i in (1, 2) for k in (1, 2)}
    line = run(spark, [(1, [1.0, 1.0]), (2, [2.0, 2.0]), (3, [4.0, 4.0])])
    assert {(r["component"], round(r["explained"], 9), r["whitened"] is None) for r in line} == {(1, 1, False), (2, 0, True)}


def test_empty(spark):
    for rows in ([], [(1, None)], [(1, [])]):
        assert run(spark, rows) == []


def test_large_values(spark):
    rows = [(k, [float(k * 10**7), float(-(k**2) * 10**6), 3.0 * k]) for k in range(40)]
    found = {(r["vec_id"], r["component"]): r["deviation"] for r in run(spark, rows)}
    for i, k, _, deviation, _, _ in brute(rows, 3):
        assert found[i, k] == (deviation if deviation < 2**63 else None)


@pytest.mark.parametrize("seed", range(6))
def test_singular_values(seed):
    rng = np.random.default_rng(seed)
    for n in (1, 2, 3, 17, 60):
        a, b = rng.normal(size=n), rng.normal(size=n - 1)
        if seed == 1:
            a, b = 10.0 ** rng.uniform(-12, 0, n), 10.0 ** rng.uniform(-12, 0, n - 1)
        if seed == 2:
            b[rng.random(n - 1) < 0.4] = 0
        if seed == 3:
            a[rng.random(n) < 0.3] = 0
        if seed == 4:
            a, b = np.ones(n), np.full(n - 1, 1e-9)
        if seed == 5:
            a, b = np.arange(n, 0, -1.0) ** 3, np.ones(n - 1)
        b = b[: max(0, n - 1)]
        full = np.diag(a) + np.diag(b, 1) if n > 1 else np.diag(a)
        expected = np.linalg.svd(full, compute_uv=False)
        found = whiten.singular_values(a, b)
        assert np.abs(found - expected).max() <= 1e-13 * expected[0]


def test_small_singular_values_are_accurate():
    # Values of a bidiagonal matrix are determined to full relative accuracy by its entries.
    a, b = np.array([1.0, 1e-8, 1e-16]), np.array([1.0, 1e-8])
    found = whiten.singular_values(a, b)
    assert abs(np.prod(found) / np.prod(a) - 1) < 1e-12


@pytest.mark.parametrize("copies", [1, 2, 3])
def test_vectors_of_equal_values_are_orthogonal(copies):
    rng = np.random.default_rng(copies)
    rotation = np.linalg.qr(rng.normal(size=(12, 12)))[0]
    square = np.diag([5.0] * copies + [4.0] * copies + [1.0] * (12 - 2 * copies)) @ rotation
    a, b, right = whiten.bidiagonal(square)
    values = whiten.singular_values(a, b)[: 2 * copies]
    v = right @ whiten.right_vectors(a, b, values)
    assert np.abs(v.T @ v - np.eye(2 * copies)).max() < 1e-12
    assert np.abs(square.T @ (square @ v) - v * values**2).max() < 1e-10


def test_values_that_agree_to_rounding():
    # Wilkinson's matrix: no coupling is small, yet the largest eigenvalues agree in pairs.
    t = np.diag(np.abs(np.arange(-10.0, 11.0)) + 3) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1)
    full = np.linalg.cholesky(t).T
    a, b = np.diag(full), np.diag(full, 1)
    values = whiten.singular_values(a, b)[:6]
    v = whiten.right_vectors(a, b, values)
    assert np.abs(v.T @ v - np.eye(6)).max() < 1e-12
    assert np.abs(t @ v - v * values**2).max() < 1e-11


def test_query(spark, sf_dir):
    found = driver.queries()["op12_qd_whitening"](spark, sf_dir).collect()
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    check(found, brute(rows))
