"""Ball k-means against plain rounds over all entries."""

import hashlib

import numpy as np
import pytest

from sievewatt.llm import ballkmeans

SCHEMA = "vec_id long, embedding array<float>, label int, v string, part string, n string, codes string, error string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, lab, "v", "p", "n", "c", "e") for i, v, lab in rows], SCHEMA)


def plain(rows, entries, parts=4, rounds=4):
    """All rows of one number of components, in plain Python integers."""
    kept = [
        (i, [int(np.floor(float(np.float32(x)) * 1024)) for x in v], lab)
        for i, v, lab in rows
        if v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    dim = len(kept[0][1])
    cut = [(p * dim // parts, (p + 1) * dim // parts) for p in range(parts)]
    start = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[r[1][lo:hi] for r in start] for lo, hi in cut]

    def nearest(v, p):
        lo, hi = cut[p]
        return min((sum((a - b) ** 2 for a, b in zip(v[lo:hi], c, strict=True)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        own = [[nearest(v, p)[1] for p in range(parts)] for _, v, _ in kept]
        for p, (lo, hi) in enumerate(cut):
            for e in range(len(books[p])):
                mine = [v[lo:hi] for (_, v, _), o in zip(kept, own, strict=True) if o[p] == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    sha = hashlib.sha256(",".join(str(x) for p in books for c in p for x in c).encode()).hexdigest()
    coded = []
    for i, v, lab in kept:
        found = [nearest(v, p) for p in range(parts)]
        coded.append((i, lab, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found)))
    per = {}
    for _, lab, _, err in coded:
        per[lab] = per.get(lab, 0) + err
    return sorted(((i, c, err, per[lab], sha) for i, lab, c, err in coded), key=repr)


def found(df, entries):
    got = ballkmeans.compress(ballkmeans.scaled(df), entries)
    return sorted(((r["vec_id"], r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in got.collect()), key=repr)


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (3, [0.5, -0.25, 0.1, 0.0, 1.0], 1), (2, [0.5, -0.25, 0.1, 0.0, 1.0], None), (4, None, 1), (5, [nan, 0.0, 0.0, 0.0, 0.0], 1),
        (6, [inf, 0.0, 0.0, 0.0, 0.0], 1), (7, [None, 0.0, 0.0, 0.0, 0.0], 1), (8, [0.0] * 5, None), (8, [0.0] * 5, None),
        (None, [-3.0, 2.0, 0.3, 0.3, 0.3], 2), (1, [0.6, -0.2, 0.1, 0.05, 0.9], 2), (9, [-0.001] * 5, 2), (10, [0.25, 0.0, 0.0, 0.0, 0.0], 3),
    ]
    for entries in (1, 2, 3, 256):
        assert found(frame(spark, rows), entries) == plain(rows, entries)
    assert found(frame(spark, []), 4) == []
    assert found(frame(spark, [(1, [], 1), (2, [], 1)]), 4) == plain([(1, [], 1), (2, [], 1)], 4)


def test_numbers_of_components_do_not_mix(spark):
    one, two = [(i, [i / 7, -i / 3], 0) for i in range(9)], [(i, [i / 5, 0.1, 0.2, i / 2], 1) for i in range(9)]
    got = found(frame(spark, one + two), 3)
    assert got == sorted(plain(one, 3) + plain(two, 3), key=repr)


@pytest.mark.parametrize("kind", ["clusters", "grid", "copies"])
def test_random_vectors(spark, kind):
    rng = np.random.default_rng(3)
    if kind == "clusters":
        v = rng.normal(size=(12, 8))[rng.integers(0, 12, 500)] + 0.1 * rng.normal(size=(500, 8))
    elif kind == "grid":
        # whole steps of 1/1024 on a small grid: many ties
        v = rng.integers(-3, 4, size=(500, 8)) / 1024
    else:
        v = rng.normal(size=(500, 8))
        v[100:300] = v[7]
    rows = [(int(i), [float(np.float32(x)) for x in r], int(i) % 5) for i, r in enumerate(v)]
    assert found(frame(spark, rows), 16) == plain(rows, 16)


def test_balls_spare_comparisons_and_change_nothing():
    rng = np.random.default_rng(9)
    x = (rng.normal(size=(40, 4))[rng.integers(0, 40, 4000)] * 1000 + rng.normal(size=(4000, 4)) * 30).astype(np.int64)
    book = x[:40].copy()
    own, dist, _ = ballkmeans.Balls(book, None).first(x)
    reach = np.full(40, -1)
    np.maximum.at(reach, own, dist)
    entry, d, compared = ballkmeans.Balls(book, reach).assign(x, own)
    assert (entry == own).all() and (d == dist).all()
    assert compared < len(x) * len(book) / 4


def test_distances_stay_exact_when_doubles_do_not_hold_them():
    big = ballkmeans.LIMIT
    x, c = np.array([[big, -big, big - 1] * 20]), np.array([[-big, big, 1] * 20])
    assert ballkmeans.squares(x, c)[0, 0] == sum((int(a) - int(b)) ** 2 for a, b in zip(x[0], c[0], strict=True))
