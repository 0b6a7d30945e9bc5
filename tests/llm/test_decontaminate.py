"""Hits against a plain search for every window, and what is removed."""

import random
import re

from rows import BASE, ODD, documents

from sievewatt.llm import decontaminate

ITEMS = [
    (10, BASE.upper() + "!"),
    (11, "fox jumps over the lazy dog and runs far away from all the noise of the"),
    (2, "one"),
    (3, "Two, three"),
    (4, None),
    (5, ""),
    (6, "?! --"),
    (10, BASE.upper() + "!"),
    (None, "four words are here"),
]


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def plain(text, items, n=10):
    w, hit, ids = words(text), set(), set()
    for i, t in items:
        own = words(t)
        k = min(n, len(own))
        grams = {tuple(own[j : j + k]) for j in range(len(own) - k + 1)} if own else set()
        for j in range(len(w) - k + 1):
            if grams and tuple(w[j : j + k]) in grams:
                hit |= set(range(j, j + k))
                ids.add(i)
    return len(w), len(hit), sorted(str(i) for i in ids if i is not None)


def compare(spark, rows, items):
    table = spark.createDataFrame([(i, t, 1, "g") for i, t in items], "item_id long, text string, k int, gram string")
    got = decontaminate.hits(documents(spark, rows), table).collect()
    mine = sorted((repr(r["id"]), r["n_words"], r["n_hit"], sorted(map(str, r["items"]))) for r in got)
    assert mine == sorted((repr(r[0]), *plain(r[1], items)) for r in rows)


def test_awkward_rows(spark):
    more = [(20, "É one Été"), (21, "two three two THREE"), (22, BASE + " and so on. " + BASE), (23, "x" + BASE), (24, BASE[:-6])]
    compare(spark, [*ODD, *more], ITEMS)
    compare(spark, ODD, [(1, None)])
    compare(spark, ODD, [])
    compare(spark, [], ITEMS)


def test_random_texts(spark):
    rng = random.Random(4)
    text = lambda n: " ".join(rng.choice("abc") for _ in range(n))
    items = [(i, text(rng.choice([3, 9, 10, 14]))) for i in range(12)]
    rows = [(i, text(rng.choice([0, 2, 8, 30, 200])) + " " + (rng.choice(items)[1] if i % 2 else "")) for i in range(40)]
    compare(spark, rows, items)


def test_shuffled_beyond_the_bound(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "MOST_WINDOWS", 1)
    compare(spark, ODD, ITEMS)


def test_removal(spark):
    docs = documents(spark, [(1, BASE), (2, "Clean text stays."), (3, f"Before it; {BASE.title()}! And, after."), (None, BASE), (4, None), (2, BASE)])
    items = spark.createDataFrame(ITEMS[:1], "item_id long, text string")
    kept = decontaminate.remove_documents(docs, items)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == [(2, "Clean text stays."), (4, None)]
    cut = {(r["doc_id"], r["text"]) for r in decontaminate.remove_spans(docs, items).collect()}
    assert cut == {(1, ""), (2, "Clean text stays."), (3, "Before it; ! And, after."), (None, ""), (4, None), (2, "")}
