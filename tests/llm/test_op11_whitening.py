import math

import numpy as np
import pytest

from pavespark.llm import whitening as wh

SCHEMA = "vec_id long, embedding array<double>, n string, v string, component string, whitened string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", "y", "z", "w") for i, v in rows], SCHEMA)


def plain(rows, components=8):
    """The contract in Python's integers and numpy's own eigenvectors."""
    ok = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(1024 * c) + 100_000 for c in v] for _, v in ok]
    n, dims = len(x), len(x[0])
    s = [sum(r[j] for r in x) for j in range(dims)]
    deviation = [sum((n * r[j] - s[j]) ** 2 for j in range(dims)) for r in x]
    z = np.array([[(n * r[j] - s[j]) / n for j in range(dims)] for r in x])
    values, vectors = np.linalg.eigh(z.T @ z / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    return [i for i, _ in ok], n, deviation, z @ vectors / np.sqrt(values), values / np.trace(z.T @ z / n)


@pytest.mark.parametrize("dims", [3, 12, 40])
def test_equals_plain_version(spark, dims):
    rng = np.random.default_rng(dims)
    spread = rng.normal(size=(dims, dims)) / 5
    rows = [(i, (rng.normal(size=dims) @ spread + 0.3).tolist()) for i in range(300)]
    rows += [(7, rows[7][1]), (None, rows[9][1]), (400, None), (401, [None] * dims), (402, [math.nan] * dims),
             (403, [math.inf] + [0.0] * (dims - 1)), (404, []), (405, [1.0] * (dims + 1))]
    ids, n, deviation, coordinates, explained = plain([r for r in rows if r[0] != 405])
    found = wh.whitened(frame(spark, rows)).collect()
    k = min(8, dims)
    assert len(found) == k * len(ids)
    assert {r["n"] for r in found} == {n} and len({r["identity_error"] for r in found}) == 1
    assert found[0]["identity_error"] < 1e-9
    by = {}
    for r in found:
        by.setdefault(r["component"], []).append(r)
    for c in range(1, k + 1):
        mine = sorted(((r["vec_id"] is None, r["vec_id"] or 0), r["deviation"], r["whitened"]) for r in by[c])
        sign = 1 if sum(r["whitened"] * w for r, w in zip(
            sorted(by[c], key=lambda r: (r["vec_id"] is None, r["vec_id"] or 0)),
            [w for _, w in sorted(zip([(i is None, i or 0) for i in ids], coordinates[:, c - 1], strict=True))],
            strict=True)) > 0 else -1
        want = sorted(((i is None, i or 0), d, sign * w) for i, d, w in
                      zip(ids, deviation, coordinates[:, c - 1], strict=True))
        assert [m[:2] for m in mine] == [w[:2] for w in want]
        assert np.allclose([m[2] for m in mine], [w[2] for w in want], rtol=1e-8, atol=1e-8)
        assert by[c][0]["explained"] == pytest.approx(explained[c - 1], rel=1e-10)


def test_table_without_usable_vectors(spark):
    assert wh.whitened(frame(spark, [])).collect() == []
    found = wh.whitened(frame(spark, [(1, None), (2, []), (3, [None])]))
    assert found.collect() == [] and found.columns[:3] == ["vec_id", "component", "n"]


def test_equal_vectors_and_few_vectors(spark):
    found = wh.whitened(frame(spark, [(1, [0.5, 1.0, 2.0])] * 3)).collect()
    assert len(found) == 9 and all(r["whitened"] is None and r["explained"] is None
                                   and r["identity_error"] is None and r["deviation"] == 0 for r in found)
    found = wh.whitened(frame(spark, [(1, [0.5, 1.0, 2.0]), (2, [0.25, 1.0, 4.0])])).collect()
    assert sorted((r["component"], r["whitened"] is None) for r in found) == [
        (1, False), (1, False), (2, True), (2, True), (3, True), (3, True)]
    assert sorted(abs(r["whitened"]) for r in found if r["component"] == 1) == pytest.approx([1, 1])
    assert {r["explained"] for r in found if r["component"] > 1} == {0.0}


def test_large_entries(spark):
    """Exact integers where doubles would round, a null deviation beyond a long."""
    rows = [(1, [1e9, 0.5]), (2, [-1e9, 0.25]), (3, [3.0, -7.0]), (4, [1e300, 0.0])]
    found = wh.whitened(frame(spark, rows[:3])).collect()
    x = [[math.floor(1024 * c) + 100_000 for c in v] for _, v in rows[:3]]
    s = [sum(r[j] for r in x) for j in range(2)]
    want = {i: sum((3 * r[j] - s[j]) ** 2 for j in range(2)) for (i, _), r in zip(rows[:3], x, strict=True)}
    assert {r["vec_id"]: r["deviation"] for r in found} == {i: d if d < 2 ** 63 else None for i, d in want.items()}
    assert any(d >= 2 ** 63 for d in want.values()) and found[0]["identity_error"] < 1e-4
    assert {r["deviation"] for r in wh.whitened(frame(spark, rows)).collect()} >= {None}


@pytest.mark.parametrize("kind", ["random", "ties", "close", "zero", "graded", "negative"])
def test_inertia_counts_and_eigenpairs(kind):
    rng = np.random.default_rng(5)
    n = 24
    q, _ = np.linalg.qr(rng.normal(size=(n, n)))
    values = {"random": rng.normal(size=n) ** 2, "ties": np.repeat([9.0, 9.0, 4.0, 1.0], 6),
              "close": 5 + 1e-9 * np.arange(n), "zero": np.zeros(n), "graded": 10.0 ** -np.arange(n),
              "negative": -np.arange(n).astype(float)}[kind]
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    true = np.sort(np.linalg.eigvalsh(a))[::-1]
    for shift in (true[:-1] + true[1:]) / 2:
        if np.abs(true - shift).min() > 1e-12 * max(1, np.abs(true).max()):
            assert wh.Factors(a - shift * np.eye(n)).positive() == int((true > shift).sum())
    found = wh.Spectrum(a, 8)
    scale = max(np.abs(true).max(), 1e-300)
    vectors = np.stack(found.vectors, axis=1)
    assert np.allclose(found.values, true[:8], rtol=0, atol=1e-13 * scale * n)
    assert np.abs(a @ vectors - vectors * found.values).max() <= 1e-12 * scale * n
    assert np.abs(vectors.T @ vectors - np.eye(8)).max() < 1e-6
    assert max(found.within) <= 1e-9 * scale + 1e-130


def test_solves_with_pivots_of_both_orders():
    rng = np.random.default_rng(1)
    for _ in range(20):
        a = rng.normal(size=(9, 9))
        a = a + a.T
        a[np.diag_indices(9)] *= rng.integers(0, 2, 9)
        b = rng.normal(size=9)
        factors = wh.Factors(a)
        assert np.allclose(a @ factors.solve(b), b, atol=1e-8)
        assert factors.positive() == int((np.linalg.eigvalsh(a) > 0).sum())
