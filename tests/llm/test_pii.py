"""Base spans against Python's patterns, and what the trees may add."""

import random
import re
from collections import Counter

from pyspark.sql import functions as F
from rows import ODD, documents

from sievewatt.llm import pii

# The contract's patterns.
PATTERNS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def right(kind, m):
    digits = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(x) <= 255 for x in m.split("."))
    if kind == "phone":
        return 9 <= len(digits) <= 15
    if kind == "card":
        total = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits)))
        return 12 <= len(digits) <= 19 and total % 10 == 0
    return True


def plain(text):
    spans = [(m.start(), k, m.end()) for k, (kind, p) in enumerate(PATTERNS) for m in re.finditer(p, text or "") if right(kind, m[0])]
    return sorted(spans)


TRICKY = [
    "mail a.b+c@x-y.example.org. or a@b, a@b.c@d.e f..g@h..i j@k.l.", "@x.y a@.b %@-.-", "1.2.3.4.5.6.7.8 256.1.1.1 0001.000.255.0 1..2.3.4",
    "4111 1111 1111 1111 and 4111-1111-1111-1111, 4111  1111 1111 1111", "4111111111111111 5 4111111111111111", "41111111111111112",
    "+1 (017) 555-7713 +4930901820 +1 2 +123456789012345678 ++49 30 901820-9", "é 𝒳 +1 (017) 555-7713 x", "4\x004111 a@b.c", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6",
    "0" * 6000, "a." * 4000 + "a@" + "b." * 4000 + "c", "1 " * 5000, "a@b.c" * 300, "\n+1 (017) 555-7713\n12.34.56.78\n",
]


def base(df):
    return [(r["id"], [tuple(s) for s in r["base"]], [tuple(s) for s in r["added"]]) for r in df.collect()]


def test_base_spans(spark):
    rng = random.Random(9)
    noise = ["".join(rng.choice("0123456789 -.@+()ab\x20") for _ in range(rng.randint(5, 120))) for _ in range(150)]
    rows = [(i, t) for i, t in enumerate(TRICKY + noise)]
    got = {i: b for i, b, _ in base(pii.detect(documents(spark, rows)))}
    for i, t in rows:
        assert got[i] == plain(t), t[:200]


def test_awkward_rows(spark):
    got = base(pii.detect(documents(spark, ODD)))
    assert sorted(map(repr, got)) == sorted(repr((r[0], plain(r[1]), [])) for r in ODD)
    assert base(pii.detect(documents(spark, []))) == []


def test_trees_add_only_likely_spans(spark):
    rng = random.Random(3)
    rows = []
    for i in range(500):
        n = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
        rows.append((3 * i, f"please call +1 ({n(3)}) 555-{n(4)} or write to me{i}.x@mail{i % 9}.example.com today"))
        rows.append((3 * i + 1, f'the token = "{n(3)}ab{n(9)}f{n(7)}" and part {n(2)}/{n(2)}-{n(3)} of {n(7)} things'))
    rows.append((9999, "please call 1 (017) 555-7713 or write to me7.x (at) mail3.example.com today"))
    got = {i: (b, a) for i, b, a in base(pii.detect(documents(spark, rows)))}
    texts = dict(rows)
    for i, (spans, added) in got.items():
        assert spans == plain(texts[i])
        assert i % 3 != 1 or not added
        assert all(texts[i][a:b] for a, _, b in added)


def test_other_forms_are_added(spark):
    rng = random.Random(4)
    n = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    rows = []
    for i in range(400):
        phone = f"+1 ({n(3)}) 555-{n(4)}" if i % 2 else f"+49 30 {n(6)}"
        rows.append((2 * i, f"please call {phone} or write to me{i}.x@mail{i % 9}.example.com, card 4111 1111 1111 1111"))
        rows.append((2 * i + 1, f'the id = "{n(16)}" and part {n(2)}/{n(2)}-{n(3)} of {n(7)} in {n(4)}.{n(4)}.{n(4)}'))
    wanted = {9001: "me7.x (at) mail3.example.com", 9002: "1 (017) 555-7713", 9003: "4111.1111.1111.1111", 9004: "0049 30 901820"}
    told = {9001: "or write to {} today", 9002: "please call {} today", 9003: "x@y.example.com, card {} now", 9004: "please call {} or not"}
    rows += [(i, told[i].format(w)) for i, w in wanted.items()]
    rows.append((9005, "x@y.example.com, card 4111.1111.1111.1112 now"))
    got = {i: [dict(rows)[i][a:b] for a, _, b in added] for i, _, added in base(pii.detect(documents(spark, rows)))}
    assert {i: got[i] for i in wanted} == {i: [w] for i, w in wanted.items()}
    assert not any(v for i, v in got.items() if i not in wanted)


def test_redaction(spark):
    docs = documents(spark, [(1, "write to a@b.cd or +1 (017) 555-7713!"), (2, None), (3, "nothing"), (4, "9 +14111111111111111")])
    out = pii.redact(docs)
    assert out.columns == docs.columns
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    assert got[1] == "write to [email] or [phone]!" and got[2] is None and got[3] == "nothing"


def test_redaction_where_ids_repeat_or_are_missing(spark):
    mail, phone = "write to a@b.cd please", "the long way: +1 (017) 555-7713 call"
    rows = [(1, mail), (1, phone), (1, "clean text"), (None, phone), (None, mail), (None, None), (None, mail), (2, "")]
    got = pii.redact(documents(spark, rows)).collect()
    told = {mail: "write to [email] please", phone: "the long way: [phone] call"}
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter((i, told.get(t, t)) for i, t in rows)


def test_all_candidates_teach(spark):
    n = 24_000
    text = F.concat(F.lit("write to me"), F.col("id").cast("string"), F.lit("@x.org or token = "), (F.col("id") * 7919 + 10_000_000).cast("string"))
    rows = pii.proposals(pii.read(spark.range(n).select(F.col("id").alias("doc_id"), text.alias("text"))))
    got = {(r["kind"], r["label"]): (r["n"], r["parts"]) for r in pii.lessons(rows).groupBy("kind", "label").agg(F.sum("n").alias("n"), F.countDistinct("part").alias("parts")).collect()}
    # each mail with its four other forms, and each number after a name of a secret
    assert got == {(0, 1.0): (5.0 * n, 2), (3, 0.0): (1.0 * n, 2)}
