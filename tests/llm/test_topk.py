import math
import random

import pytest

from churnflow.llm import topk as t


def brute(rows, k):
    best = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            q = [math.floor(256 * x) for x in v]
            best[i] = min(best.get(i, q), q)
    out = set()
    for i, q in best.items():
        if i % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in best.items() if j != i)
            out |= {(i, r + 1, j, -s) for r, (s, j) in enumerate(scores[:k])}
    return out


def search(spark, rows, k=5):
    frame = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], "vec_id long, embedding array<float>, label string, block string")
    q = t.quantized(frame.repartition(3) if rows else frame)
    return {tuple(r) for r in t.top_k(q.where("vec_id % 50 = 0"), q, k).select("query_id", "rank", "vec_id", "score").collect()}


@pytest.mark.parametrize("dim, blocks, few", [(16, False, 0), (16, True, 2), (3, True, 0.05), (1, False, 2)])
def test_equals_brute_force(spark, monkeypatch, dim, blocks, few):
    monkeypatch.setattr(t, "FEW", few)
    if blocks:
        monkeypatch.setattr(t, "QUERIES_AT_ONCE", 4)
        monkeypatch.setattr(t, "FIRST_ROWS", 100)
        monkeypatch.setattr(t, "BOUNDS_AT_ONCE", 50)
        monkeypatch.setattr(t, "SCORES_AT_ONCE", 7)
    rng = random.Random(dim)
    # Quarters are exact as floats; few values make many ties.
    rows = [(i, [rng.randint(-6, 6) / 4 for _ in range(dim)]) for i in range(700)]
    nan, inf = float("nan"), float("inf")
    rows += [(None, [1.0] * dim), (1000, None), (1050, [None] + [1.0] * (dim - 1)), (1100, [nan] * dim), (1150, [inf] * dim), (1200, []), (1250, [1.0]),
             (50, [0.5] * dim), (51, rows[51][1]), (1300, [1000.0] * dim)]
    assert search(spark, rows) == brute(rows, 5)


def test_few_or_no_rows(spark):
    assert search(spark, []) == set()
    assert search(spark, [(50, [1.0])]) == set()
    assert search(spark, [(50, [1.0]), (3, [2.0])]) == {(50, 1, 3, 256 * 512)}
    assert search(spark, [(0, []), (50, [])]) == {(0, 1, 50, 0), (50, 1, 0, 0)}


def test_bounds_hold_and_tighten():
    import numpy as np

    rng = np.random.default_rng(2)
    q, x = rng.integers(-300, 300, (20, 37)).astype(float), rng.integers(-300, 300, (50, 37)).astype(float)
    exact, last = x @ q.T, None
    for n in t.LEVELS:
        bound = t._statistics(x, n) @ t._statistics(q, n).T
        assert (bound >= exact - 1e-6).all()
        assert last is None or bound.sum() < last
        last = bound.sum()


def test_thresholds_leave_little_to_send(spark):
    """With first thresholds, tasks send on few of the pairs, and the result is the same."""
    import numpy as np

    rng = np.random.default_rng(3)
    v = rng.integers(-200, 200, (3000, 24))
    rows = spark.createDataFrame([(int(i), [int(c) for c in x]) for i, x in enumerate(v)], "vec_id long, v array<long>").repartition(6)
    q, ids = v[:40], np.arange(40)
    scores = np.where(np.arange(3000)[:, None] == ids, -(10**9), v @ q.T)
    best = np.sort(scores, axis=0)[-5]
    found = t._search(rows, ids, q, best, 5).collect()
    assert {(r["query"], r.vec_id, r.score) for r in found} == {(j, i, int(scores[i, j])) for i, j in zip(*np.nonzero(scores >= best))}
