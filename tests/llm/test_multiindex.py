"""The inverted multi-index against all products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievewatt.llm import multiindex

SCHEMA = "vec_id long, embedding array<float>, label int, v string, dim string, length string, cell string, block string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "v", "d", "l", "c", "b") for i, v in rows], SCHEMA)


def product(a, b):
    total = 0.0
    for x, y in zip(a, b, strict=True):
        total += x * y
    return total


def plain(rows, every, k=20):
    ok = [
        (i, tuple(float(np.float32(x)) for x in v))
        for i, v in rows
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    out = []
    for q, qv in {(i, v) for i, v in ok if i % every == 0}:
        s = sorted((-product(qv, v), i) for i, v in ok if i != q and len(v) == len(qv))
        out += [(q, n + 1, i, -x) for n, (x, i) in enumerate(s[:k])]
    return sorted(out)


def found(df, every, **kw):
    got = multiindex.search(multiindex.usable(df), F.col("vec_id") % every == 0, **kw)
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got.collect())


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [0.5, -0.25]), (2, [0.5, -0.25]), (4, [0.1, 0.1]), (6, None), (8, [nan, 0.0]), (10, [inf, 1.0]), (12, [None, 1.0]),
        (1, [0.0, 0.0]), (3, [100.0, -3.0]), (5, [-1.0, -1.0]), (7, [1.0, 2.0, 3.0]), (14, [1.0, 2.0, 4.0]), (16, []), (None, [1.0, 1.0]),
        (18, [0.5, -0.25]), (20, [0.5, -0.25]), (22, [2.0]), (24, [-3.0]), (26, [0.1, 0.1]), (26, [0.1, 0.1]), (28, [1.0] * 9),
    ]
    assert found(frame(spark, rows), 2) == plain(rows, 2)
    assert found(frame(spark, rows), 2, block=2, query_block=1) == plain(rows, 2)
    assert found(frame(spark, []), 2) == []
    assert found(frame(spark, [(0, [1.0])]), 2) == []


def made(n, dim, seed, lengths=False):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(40, dim))[rng.integers(0, 40, n)] + 0.9 * rng.normal(size=(n, dim))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    if lengths:
        v *= rng.uniform(0.5, 1.5, size=(n, 1))
    return [(int(i), [float(np.float32(x)) for x in r]) for i, r in enumerate(v)]


@pytest.mark.parametrize("lengths", [False, True])
def test_recall_and_scores(spark, lengths):
    rows = made(6000, 32, 2, lengths)
    if lengths:
        # a third of all rows are one vector
        rows[::3] = [(i, rows[1][1]) for i, _ in rows[::3]]
    want, got = plain(rows, 100), found(frame(spark, rows), 100, least=50, block=700, query_block=17, centroids=64)
    scores = {(q, v): s for q, _, v, s in want}
    cut = {q: min(s for q2, _, _, s in want if q2 == q) for q in {w[0] for w in want}}
    assert [g[:2] for g in got] == [w[:2] for w in want]
    # a vector as near as the last true one is as good
    hit = sum(s >= cut[q] - 1e-12 for q, _, _, s in got)
    assert hit / len(want) >= 0.9
    assert all(s == scores.get((q, v), s) for q, _, v, s in got)


def test_whole_share_is_exact(spark):
    rows = made(700, 16, 5, True) + [(700 + i, [0.25] * 16) for i in range(40)]
    assert found(frame(spark, rows), 20, share=1.0, least=1, block=60, query_block=7, centroids=16) == plain(rows, 20)


def test_cells_come_in_order_of_summed_distance():
    rng = np.random.default_rng(1)
    near, far, counts = rng.uniform(size=9), rng.uniform(size=7), rng.integers(0, 3, 63)
    last, taken = multiindex.traverse(near, far, counts, int(counts.sum()))
    sums = (near[:, None] + far[None, :]).reshape(-1)
    assert taken == [c for c in np.argsort(sums, kind="stable") if counts[c]]
    few_last, few = multiindex.traverse(near, far, counts, 10)
    assert few == taken[: len(few)] and counts[few].sum() >= 10 > counts[few[:-1]].sum() and few_last == sums[few[-1]] <= last


def test_blocks_are_bounded():
    counts = np.array([3, 0, 4, 25, 1, 9, 2])
    first, parts, used = multiindex.pack(counts, 10)
    assert used == max(first + parts)
    for b in range(used):
        held = sum(-(-int(n) // int(p)) for n, f, p in zip(counts, first, parts, strict=True) if f <= b < f + p)
        assert held <= 10
