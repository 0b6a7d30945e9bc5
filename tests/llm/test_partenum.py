"""The Jaccard join against all pairs, on awkward rows and on random near copies."""

import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from rows import ODD, documents

from sievewatt.llm import partenum, shingles


def plain_set(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def plain_classes(rows):
    sets = [plain_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    ids = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        ids[find(i)].append(d)
    smallest = {r: min((d for d in own if d is not None), default=None) for r, own in ids.items()}
    return sorted((repr(d), len(sets[i]), repr(smallest[find(i)])) for i, (d, _) in enumerate(rows))


def near_copies(n, seed):
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(400)]
    line = [rng.choice(vocabulary) for _ in range(25)]
    rows = []
    for i in range(n):
        if i % 3 or not rows:
            words = [rng.choice(vocabulary) for _ in range(rng.choice([3, 6, 12, 40, 150]))] + line * rng.choice([0, 1])
        else:
            words = rng.choice(rows)[1].split(" ")
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((i, " ".join(words)))
    return rows


def classes(df):
    return sorted((repr(r["id"]), r["n"], repr(r["class_id"])) for r in partenum.join(df).collect())


def _one_group():
    def one_group(table):
        keys = np.unique(np.concatenate([np.frombuffer(k, np.int64) for k in table["keys"].to_pylist()]))
        return pa.table({"lead": pa.array(np.full(len(keys) - 1, keys[0])), "key": pa.array(keys[1:])})

    return one_group


one_group = _one_group()


def test_awkward_rows(spark):
    rows = [r[:2] for r in ODD]
    assert classes(documents(spark, rows)) == plain_classes(rows)
    assert classes(documents(spark, rows).limit(0)) == []
    assert classes(documents(spark, [(1, None), (2, "")])) == [("1", 0, "1"), ("2", 0, "2")]


def test_random_near_copies(spark):
    rows = near_copies(240, 5)
    assert classes(documents(spark, rows).repartition(3)) == plain_classes(rows)


def test_large_groups_are_split_and_still_exact(spark, monkeypatch):
    monkeypatch.setattr(partenum, "GROUP_MEMBERS", 3)
    rows = near_copies(90, 6)
    assert classes(documents(spark, rows)) == plain_classes(rows)


def bounded(monkeypatch, most):
    """Make a task that is given more than ``most`` members fail."""
    for name in ("_staying", "_checked"):
        made = getattr(partenum, name)

        def guarded(percent, made=made):
            run = made(percent)

            def checked(table):
                assert table.num_rows <= most, table.num_rows
                return run(table)

            return checked

        monkeypatch.setattr(partenum, name, guarded)


def test_cluster_above_the_limit_goes_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(partenum, "GROUP_MEMBERS", 60)
    bounded(monkeypatch, 120)
    rng = random.Random(8)
    base = [f"t{i}" for i in range(80)]
    rows = []
    for i in range(260):  # near the template; some are near it only by way of others
        words = list(base)
        for _ in range(rng.choice([0, 1, 1, 2])):
            words[rng.randrange(80)] = f"x{i}"
        rows.append((i, " ".join(words)))
    assert classes(documents(spark, rows)) == plain_classes(rows)


@pytest.mark.parametrize("members", [2, 5])
def test_blocks_leave_out_no_pair(spark, monkeypatch, members):
    monkeypatch.setattr(partenum, "GROUP_MEMBERS", members)
    monkeypatch.setattr(partenum, "LEVELS", 1)
    # one group of all sets, most of them apart from each other
    monkeypatch.setattr(partenum, "_met", one_group)
    monkeypatch.setattr(partenum, "LEAST_GROUPS", 1)
    rows = near_copies(60, 7)
    assert classes(documents(spark, rows)) == plain_classes(rows)


def test_repeated_rows_are_carried_once(spark, monkeypatch):
    bounded(monkeypatch, 10)
    text = " ".join(f"t{i}" for i in range(80))
    rows = [(1, text)] * 1500 + [(None, text + " a")] * 1500 + [(2, text + " b"), (3, text + " b")]
    got = classes(documents(spark, rows).repartition(5))
    assert got == sorted([("1", 76, "1")] * 1500 + [("None", 77, "1")] * 1500 + [("2", 77, "1"), ("3", 77, "1")])


def test_one_of_each_class_stays(spark):
    kept = partenum.one_of_each(documents(spark, [r[:2] for r in ODD]))
    ids = sorted((repr(r["doc_id"]), (r["text"] or "")[:9]) for r in kept.collect())
    assert ids == sorted(
        [("1", "the quick"), ("4", ""), ("5", ""), ("6", " \t\n "), ("7", "word0 of0"), ("8", "one two t"), ("10", "four word"), ("None", "")]
    )
    assert kept.columns == documents(spark, []).columns


def test_signatures_meet_for_every_linked_pair():
    rng = np.random.default_rng(3)
    bands = partenum.Bands.of(75)
    none = np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        for size in [1, 2, 3, 4, 5, 7, 9, 14, 30, 77, 300, 1500]:
            for _ in range(60):
                r = np.unique(rng.integers(0, 2**63, size, np.uint64) * np.uint64(2))
                keep = int(np.ceil(len(r) * rng.uniform(0.75, 1)))
                s = np.unique(np.concatenate((r[:keep], rng.integers(0, 2**63, rng.integers(0, 1 + size // 4), np.uint64))))
                if partenum.linked(r, s, 75):
                    often = np.sort(r[:: 2])
                    for f in (none, often):
                        a, b = partenum.signatures(r, f, bands), partenum.signatures(s, f, bands)
                        assert np.intersect1d(a, b).size


@pytest.mark.parametrize("text", ["", "a", "a b c d", "a b c d e", "A b\tc\nd  e f", "x " * 40, "é É a\x0bb\x1cc d e"])
def test_set_sizes(text):
    assert len(next(shingles.sets_of([text]))) == len(plain_set(text))


def test_pieces_of_long_texts_give_the_same_words():
    text = " ".join(f"w{i}" for i in range(5000))
    assert (shingles.word_hashes(text, 1000) == shingles.word_hashes(text)).all()
