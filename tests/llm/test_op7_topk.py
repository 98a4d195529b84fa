import numpy as np
import pytest

from pavespark.llm import topk_bnb

SCHEMA = "vec_id long, embedding array<double>, label int, v string, g string, score string"


def brute(rows, k, every):
    vectors = [(i, [int(np.floor(64.0 * x)) for x in v]) for i, v in rows
               if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i in sorted({i for i, _ in vectors if i % every == 0}):
        for q in [min((v for j, v in rows if j == i and v is not None))]:
            q = [int(np.floor(64.0 * x)) for x in q]
            scored = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j)
                            for j, v in vectors if j != i and len(v) == len(q))[:k]
            out += [(i, r, j, -s) for r, (s, j) in enumerate(scored, 1)]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", "y", "z") for i, v in rows], SCHEMA)


@pytest.mark.parametrize("dims", [5, 40])
def test_equals_brute_force(spark, dims):
    rng = np.random.default_rng(dims)
    rows = [(i, rng.normal(size=dims).round(2).tolist()) for i in range(400)]
    rows += [(400 + i, rows[7][1]) for i in range(60)]  # ties
    rows += [(460, None), (461, [None] * dims), (462, [float("nan")] * dims), (463, [float("inf")] * dims),
             (None, rows[3][1]), (5, rows[5][1])]
    found = topk_bnb.top_k(frame(spark, rows), k=7, group_rows=100, block_rows=8).collect()
    assert sorted(tuple(r) for r in found) == brute(rows, 7, 20)


def test_few_rows_large_numbers_and_none(spark):
    rows = [(0, [1e12, 2.0]), (1, [1e12, 3.0]), (2, [-5.5, 0.0]), (20, [1.0, 1.0, 1.0])]
    found = topk_bnb.top_k(frame(spark, rows)).collect()
    limit = (1 << 63) - 1
    assert [tuple(r) for r in sorted(found)] == [(0, 1, 1, limit), (0, 2, 2, -352 * 64 * 10 ** 12)]
    assert topk_bnb.top_k(frame(spark, [])).collect() == []


def test_pruning_keeps_the_best():
    rng = np.random.default_rng(2)
    vectors = np.floor(rng.normal(size=(3000, 64)) * np.linspace(40, 1, 64))
    ids = np.arange(3000)
    block = topk_bnb.VerticalBlock(ids, vectors)
    for q in range(10):
        scores = vectors @ vectors[q]
        best = sorted((-s, i) for s, i in zip(scores.tolist(), ids.tolist(), strict=True) if i != q)[:20]
        found, got = block.best(q, vectors[q], 20)
        assert [(-s, i) for s, i in zip(got.tolist(), found.tolist(), strict=True)] == best
