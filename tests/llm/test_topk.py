"""Top-k search against all products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievewatt.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, v string, dim string, length string, score string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "v", "d", "l", "s") for i, v in rows], SCHEMA)


def plain(rows, every, k=5):
    ok = [
        (i, [int(np.floor(float(np.float32(x)) * 256)) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for q, qv in {(i, tuple(v)) for i, v in ok if i % every == 0}:
        s = sorted((-sum(a * b for a, b in zip(qv, v, strict=True)), i) for i, v in ok if i != q and len(v) == len(qv))
        out += [(q, n + 1, i, -x) for n, (x, i) in enumerate(s[:k])]
    return sorted(out)


def found(df, every, **kw):
    got = topk.search(topk.scaled(df), F.col("vec_id") % every == 0, **kw)
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got.collect())


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [0.5, -0.25]), (2, [0.5, -0.25]), (4, [0.1, 0.1]), (6, None), (8, [nan, 0.0]), (10, [inf, 1.0]), (12, [None, 1.0]),
        (1, [0.0, 0.0]), (3, [100.0, -3.0]), (5, [-1.0, -1.0]), (7, [1.0, 2.0, 3.0]), (14, [1.0, 2.0, 4.0]), (16, []), (None, [1.0, 1.0]),
        (18, [0.5, -0.25]), (20, [0.5, -0.25]), (22, [0.5, -0.25]), (24, [0.5, -0.25]), (26, [0.1, 0.1]), (26, [0.1, 0.1]),
    ]
    assert found(frame(spark, rows), 2) == plain(rows, 2)
    assert found(frame(spark, []), 2) == []
    assert found(frame(spark, [(0, [1.0])]), 2) == []


@pytest.mark.parametrize("block,query_block", [(8192, 1024), (37, 5)])
def test_random_vectors_of_many_lengths(spark, block, query_block):
    rng = np.random.default_rng(block)
    v = rng.normal(size=(400, 8)) * rng.lognormal(0, 1, size=(400, 1))
    v[300:] = v[200:300] + rng.normal(size=(100, 8)) * 0.05
    rows = [(int(i), [float(np.float32(x)) for x in r]) for i, r in enumerate(v)]
    assert found(frame(spark, rows), 10, block=block, query_block=query_block) == plain(rows, 10)


def test_products_stay_exact_when_doubles_do_not_hold_them():
    q = np.array([[2**40, 3]])
    assert topk._products(q, np.array([[2**20 + 1, 1]]))[0, 0] == 2**40 * (2**20 + 1) + 3


def shaped(kind):
    rng = np.random.default_rng(5)
    if kind == "sparse":
        v = np.maximum(rng.normal(size=(3000, 64)) - 1.2, 0)
    elif kind == "one-hot":
        v = np.eye(16)[rng.integers(0, 16, 3000)] * rng.uniform(0.5, 3, size=(3000, 1)) + 0.02 * rng.normal(size=(3000, 16))
    elif kind == "negative":
        v = -np.maximum(rng.normal(size=(3000, 64)) - 1.2, 0)
    else:
        v = rng.normal(size=(3000, 2))
    return np.floor(v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9) * 256).astype(np.int64)


@pytest.mark.parametrize("kind", ["sparse", "one-hot", "negative", "flat"])
def test_pruning_loses_no_hit_where_one_coordinate_outweighs(kind):
    c = shaped(kind)
    ids, length = np.arange(len(c)), np.sqrt((c.astype(float) ** 2).sum(1))
    q = ids[:60]
    seeds = np.argsort(-length, kind="stable")[:300]
    start = [np.sort((c[seeds[seeds != i]] @ c[i]))[-5] for i in q]
    got = sorted(topk.block_hits(q, c[q], length[q], np.array(start, float), ids, c, length, 5))
    scores = c[q] @ c.T
    want = [(int(i), int(j), int(scores[i, j])) for i in q for j in sorted(ids[ids != i], key=lambda j: (-scores[i, j], j))[:5]]
    assert got == sorted(want)


def test_one_hot_vectors_over_a_whole_table(spark, monkeypatch):
    monkeypatch.setattr(topk, "SEEDS", 20)
    rng = np.random.default_rng(11)
    v = np.eye(6)[rng.integers(0, 6, 300)] * rng.uniform(0.8, 1.0, size=(300, 1)) + np.abs(0.05 * rng.normal(size=(300, 6)))
    rows = [(int(i), [float(np.float32(x)) for x in r]) for i, r in enumerate(v)]
    assert found(frame(spark, rows), 10) == plain(rows, 10)
