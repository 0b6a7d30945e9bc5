"""Mixing and sharding against plain counts."""

import hashlib
import heapq
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from rows import ODD, documents

from sievewatt.llm import mixing, sharding
from sievewatt.llm.common import durable


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Share by weight, stop at the caps and share the rest again, until none is above."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free = {}, set(names)
    left = share * sum(sizes.values())
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > most * sizes[s]}
        if not over:
            target |= {s: left * weight[s] / total for s in free}
            break
        for s in over:
            target[s] = most * sizes[s]
        left -= sum(target[s] for s in over)
        free -= over
    return target


def many(n=400):
    return [(i, "w " * ((i * 37) % 90 + 1), ["hot", "hot", "b", "c", None][i * 7 % 5]) for i in range(n)]


def check_mix(spark, rows):
    got = mixing.mix(documents(spark, rows)).collect()
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter((r["id"], r["source"], r["size"]) for r in got) == Counter((d, s, words(t)) for d, t, s in rows)
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += words(t)
    for s, t in plain_targets(sizes).items():
        own = [r for r in got if r["source"] == s]
        assert all(r["source_size"] == sizes[s] and abs(r["target"] - t) < 1e-6 for r in own)
    assert all(0 <= r["copies"] <= 2 for r in got)
    return got


def test_targets_and_copies(spark):
    got = check_mix(spark, many())
    for s in {r["source"] for r in got}:
        own = [r for r in got if r["source"] == s]
        taken = sum(r["size"] * r["copies"] for r in own)
        assert abs(taken - own[0]["target"]) < 0.03 * own[0]["target"]
    again = {(r["id"], r["copies"]) for r in mixing.mix(documents(spark, many()).repartition(7)).collect()}
    assert again == {(r["id"], r["copies"]) for r in got}


def test_awkward_rows_in_the_mix(spark):
    check_mix(spark, ODD)
    check_mix(spark, [(1, None, "a"), (2, "", None)])
    assert mixing.mix(documents(spark, [])).collect() == []


def test_mixed_rows_keep_their_columns(spark):
    df = documents(spark, many(60))
    want = {r["id"]: r["copies"] for r in mixing.mix(df).collect()}
    out = mixing.mixed(df)
    assert out.columns == df.columns
    assert Counter(r["doc_id"] for r in out.collect()) == Counter({d: c for d, c in want.items() if c})


def taken_by_source(got):
    taken, target = Counter(), {}
    for r in got:
        taken[r["source"]] += r["size"] * r["copies"]
        target[r["source"]] = r["target"]
    return taken, target


def test_rows_that_share_an_id_draw_each_for_itself(spark):
    shared = [(None, "two words", "a")] * 600 + [(7, "w " * (i % 5 + 1), "b") for i in range(600)]
    rows = shared + [(100 + i, "one two three", "c") for i in range(300)]
    got = check_mix(spark, rows)
    taken, target = taken_by_source(got)
    assert all(abs(taken[s] - target[s]) <= 0.08 * target[s] for s in target)
    want = Counter((r["id"], r["source"], r["size"], r["copies"]) for r in got)
    again = mixing.mix(documents(spark, rows[::-1]).repartition(5)).collect()
    assert Counter((r["id"], r["source"], r["size"], r["copies"]) for r in again) == want
    out = Counter((r["doc_id"], r["source"]) for r in mixing.mixed(documents(spark, rows)).collect())
    copies = Counter()
    for r in got:
        copies[r["id"], r["source"]] += r["copies"]
    assert out == copies


def placed(spark, rows, **kw):
    return sharding.shard(documents(spark, rows), **kw).collect()


def test_schedule_is_longest_first():
    sizes = [("a", 7), ("b", 5), ("c", 4), ("d", 3), ("e", 1)]
    assert sharding.schedule(sizes, 2) == {"a": 0, "b": 1, "c": 1, "d": 0, "e": 1}


def test_shards_are_even_and_texts_together(spark):
    rows = [(i, f"text {i} " * (i % 50 + 1)) for i in range(900)] + [(1000 + i, "the very same copy") for i in range(300)]
    got = placed(spark, rows, shards=7)
    texts = dict(rows)
    assert sorted(r["id"] for r in got) == sorted(texts)
    load, slots, where = Counter(), defaultdict(list), defaultdict(set)
    for r in got:
        data = texts[r["id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 16, zlib.crc32(data))
        load[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        where[texts[r["id"]]].add(r["shard"])
    assert max(map(len, where.values())) == 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(load.values()) - min(load.values()) < 0.02 * max(load.values())


def plain_shards(rows, shards, grain, bundle_of):
    """Shard of every text by a heap over the same items: large groups singly, the others by ``bundle_of``."""
    sizes = Counter()
    for _, t in rows:
        sizes[t] += len((t or "").encode()) + 16
    total, items = sum(sizes.values()), Counter()
    name = {t: ("group", t) if n * shards * grain > total else ("bundle", bundle_of[t]) for t, n in sizes.items()}
    for t, n in sizes.items():
        items[name[t]] += n
    heap = [(0, s) for s in range(shards)]
    where = {}
    label = lambda k: f"{k[0]}:" + ("null" if k[1] is None else hashlib.md5(k[1].encode()).hexdigest() if k[0] == "group" else k[1])
    for k in sorted(items, key=lambda k: (-items[k], label(k))):
        load, shard = heapq.heappop(heap)
        where[k] = shard
        heapq.heappush(heap, (load + items[k], shard))
    return {t: where[k] for t, k in name.items()}


CORPORA = {
    "many nulls": [(i, None) for i in range(300)] + [(1000 + i, f"t{i}") for i in range(30)],
    "a third nulls": [(i, None if i % 3 == 0 else f"text {i} " * (i % 20)) for i in range(1500)],
    "one hot text": [(i, "the very same long text " * 9 if i % 3 == 0 else f"text {i}") for i in range(900)],
    "repeated rows": [(5, "again and again")] * 400 + [(None, None)] * 200 + [(i, f"x{i}" * (i % 30)) for i in range(300)],
    "only nulls": [(i, None) for i in range(50)],
}


@pytest.mark.parametrize("name", CORPORA)
def test_shards_are_those_of_a_plain_heap(spark, name):
    rows, shards, grain, bundles = CORPORA[name], 7, 8, 56
    texts = sorted({t for _, t in rows}, key=str)
    keyed = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    bundle = F.pmod(F.xxhash64(sharding.group_key(F.col("text"))), F.lit(bundles)).cast("string")
    bundle_of = {texts[r["i"]]: r["b"] for r in keyed.select("i", bundle.alias("b")).collect()}
    want = plain_shards(rows, shards, grain, bundle_of)
    got = placed(spark, rows, shards=shards, grain=grain, bundles=bundles)
    crc = lambda t: None if t is None else zlib.crc32(t.encode())
    assert Counter((r["id"], r["text_crc32"], r["shard"]) for r in got) == Counter((i, crc(t), want[t]) for i, t in rows)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_slots_where_one_row_repeats(spark):
    df = spark.createDataFrame([(1, 0)] * 700 + [(i, i % 2) for i in range(300)], "id long, shard int").repartition(4)
    got = sharding.slots(durable(df), ["id"], rows_per_run=20).collect()
    for s in range(2):
        own = [r["slot"] for r in got if r["shard"] == s]
        assert sorted(own) == list(range(len(own)))
    assert len(got) == 1000


def test_slots_in_short_runs(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(500)], "id long, shard int")
    got = sharding.slots(durable(df), ["id"], rows_per_run=20).collect()
    for s in range(3):
        own = [r["slot"] for r in got if r["shard"] == s]
        assert sorted(own) == list(range(len(own)))


def test_awkward_rows_in_shards(spark):
    got = placed(spark, [r[:2] for r in ODD])
    assert len(got) == len(ODD)
    assert Counter((r["size"], r["text_crc32"]) for r in got) == Counter(
        (len((t or "").encode()) + 16, None if t is None else zlib.crc32(t.encode())) for _, t, _ in ODD
    )
    assert placed(spark, []) == []
