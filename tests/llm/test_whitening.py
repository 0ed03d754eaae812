"""Whitening against a dense eigenvalue solver and Python integers."""

import numpy as np
import pytest

from gridclimate.llm.whitening import components, polar, whiten, whitened_rows

SCHEMA = "vec_id long, embedding array<float>, n string, component int, i string, x array<int>"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, "clash", 1, "clash", [1]) for i, v in vectors], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def vectors():
    r = np.random.default_rng(1)
    mixed = r.standard_normal((300, 12)) @ r.standard_normal((12, 12)) / 8
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(mixed)]
    rows += [(1000 + i, rows[7][1]) for i in range(150)]  # a third is one vector
    rows += [(7, rows[7][1]), (None, rows[9][1])]
    bad = [None, [], [1.0] * 11, [float("nan")] * 12, [None] * 12, [float("inf")] + [0.0] * 11, [float("-inf")] + [0.0] * 11, [0.5] * 11 + [None]]
    return rows, rows + [(2000 + i, v) for i, v in enumerate(bad)]


def expected(rows):
    x = [[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for _, v in rows]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(v, sums)) for v in x]
    c = np.array([[n * a - s for a, s in zip(v, sums)] for v in x], dtype=float) / n
    values, basis = np.linalg.eigh(c.T @ c / n)
    return n, deviation, c @ basis[:, ::-1] / np.sqrt(values[::-1]), values[::-1] / values.sum()


def test_rows_against_a_dense_solver(spark, vectors):
    good, everything = vectors
    n, deviation, white, explained = expected(good)
    rows = whitened_rows(frame(spark, everything)).collect()
    assert len(rows) == 12 * len(good) and {r["n"] for r in rows} == {n}
    table = {}
    for r in rows:
        table.setdefault(repr(r["vec_id"]), []).append(r)
    sign = np.zeros(12)
    for (i, v), d, w in zip(good, deviation, white):
        own = sorted(table[repr(i)], key=lambda r: r["component"])
        assert {r["deviation"] for r in own} == {d}
        got = np.array([r["whitened"] for r in own[::len(own) // 12]])
        assert np.allclose(np.abs(got), np.abs(w), atol=1e-8)
        sign += np.sign(got * w)
        assert np.allclose([r["explained"] for r in own[::len(own) // 12]], explained, rtol=1e-9)
    assert (np.abs(sign) >= len(good) - 2).all()  # one sign for all rows
    assert {r["identity_error"] for r in rows}.pop() < 1e-9


def test_few_components_and_the_fit(spark, vectors):
    white, fit = whiten(frame(spark, vectors[0]), most=5)
    assert white.selectExpr("max(size(whitened)) as n").first()["n"] == 5 and white.count() == len(vectors[0])
    assert np.allclose(fit["vectors"].T @ fit["vectors"], np.eye(12), atol=1e-12) and fit["size"] == 12


def test_tables_without_variance_rows_or_room(spark):
    assert whitened_rows(frame(spark, [(1, [1.0, 2.0])]).where("false")).collect() == []
    assert whitened_rows(frame(spark, [(1, None), (2, [None]), (3, [])])).collect() == []
    one = whitened_rows(frame(spark, [(1, [1.0, 2.0])])).collect()
    assert [(r["component"], r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == [(1, 1, 0, 0, 0, 0), (2, 1, 0, 0, 0, 0)]
    flat = whitened_rows(frame(spark, [(i, [float(i), 3.0]) for i in range(4)])).where("component = 2").collect()
    assert {(r["whitened"], r["explained"]) for r in flat} == {(0.0, 0.0)} and len(flat) == 4
    huge = whitened_rows(frame(spark, [(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [0.0, 0.5])])).collect()  # no long holds the deviation
    assert len(huge) == 6 and {r["deviation"] for r in huge if r["vec_id"] < 3} == {None}
    assert max(r["identity_error"] for r in huge) < 1e-4
    tie = whitened_rows(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 3.0]), (3, [1.0] * 3), (4, [2.0] * 3)])).collect()
    assert {r["vec_id"] for r in tie} == {3, 4}  # the longer of equally frequent lengths


def rotated(values, seed):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    return q * np.array(values, dtype=float) @ q.T


@pytest.mark.parametrize("values", [
    [5.0], [2, 1], [1, 1, 1, 1], [3, 3, 3, 1, 1], [1e12, 1, 1e-3], [1e6] + [1.0] * 20, list(range(1, 65)), [7, 7 - 1e-9, 3, 3 + 1e-13, 0, 0],
    list(np.logspace(0, 8, 40)), [0, 0, 0], [4, 0, 0, 0]])
def test_components_of_hard_spectra(values):
    for v in (np.diag(np.array(values, dtype=float)), rotated(values, 3)):
        v = (v + v.T) / 2
        found, basis = components(v)
        scale = max(np.abs(values))
        assert np.allclose(found, np.sort(values)[::-1], atol=1e-13 * len(values) * scale + 1e-300)
        assert np.allclose(basis.T @ basis, np.eye(len(values)), atol=1e-12)
        assert np.abs(v @ basis - basis * found).max() <= 1e-13 * len(values) * scale + 1e-300


def test_polar_factor_is_the_sign():
    a = rotated([3, 1, 1e-6, -1e-5, -2], 5)
    u = polar(a)
    assert np.allclose(u @ u, np.eye(5), atol=1e-12) and np.allclose(u, rotated([1, 1, 1, -1, -1], 5), atol=1e-9)
