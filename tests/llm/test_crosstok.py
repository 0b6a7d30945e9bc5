"""Cross-tokenizer alignment against a plain comparison of all byte ranges."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest

from sievewatt.llm import crosstok
from rows import BASE, CLASH, LONG, ODD, SCHEMA, documents


@pytest.fixture(scope="module")
def both():
    return crosstok.sides(crosstok.FOLDER, crosstok.BYTE_FILE, crosstok.PIECE_FILE)


def plain(text, both):
    """(n_a, n_b, n_groups, links, groups) from whole texts and all pairs of ranges."""
    if not text:
        return 0, 0, 0, [], ""
    ranged = []
    for side in both:
        at, out = 0, []
        for i in side.encode([text])[0]:
            out.append((at, at + len(side.pieces[i]), i))
            at += len(side.pieces[i])
        if b"".join(side.pieces[i] for _, _, i in out) != b" " + text.encode():
            return 0, 0, 0, [], ""
        ranged.append(out)
    a, b = ranged
    links = [(x, y) for lo, hi, x in a for lo2, hi2, y in b if lo < hi2 and lo2 < hi]
    ends, groups, begin = sorted({e for _, e, _ in a} & {e for _, e, _ in b}), [], 0
    for end in ends:
        groups.append("|".join(",".join(str(i) for _, e, i in of if begin < e <= end) for of in (a, b)))
        begin = end
    return len(a), len(b), len(groups), links, ";".join(groups)


TEXTS = [
    "hello world", "", None, "a  b\n\n c\td", "日本語 text émoji 😀 ᏣᎳᎩ", "x▁y", "▁", "<|endoftext|> hi", " lead", "trail  ",
    "don't stop, I'll we've", "\x00 z \x1f q", "<s> </s> <0x41>", "​   　 w", "1234567 89,5 €", " ", "\n",
    "reheednd ingouth. " * 7, BASE,
]


def test_alignment_of_awkward_texts(both):
    for r, t in zip(crosstok.align(TEXTS, *both, 8), TEXTS, strict=True):
        n_a, n_b, n_groups, links, groups = plain(t, both)
        assert (r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["groups"]) == (n_a, n_b, n_groups, len(links), groups), t
        counted = {((p >> 32), p & 0xFFFFFFFF): n for p, n in zip(r["pairs"].tolist(), r["times"].tolist(), strict=True)}
        assert counted == Counter(links)


def test_random_texts_in_pieces(both):
    rng = random.Random(4)
    letters = "abcdeé  '\n.,0ñ日😀́ł"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 80))) for _ in range(300)]
    for r, t in zip(crosstok.align(texts, *both, 5), texts, strict=True):
        n_a, n_b, n_groups, links, groups = plain(t, both)
        assert (r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["groups"]) == (n_a, n_b, n_groups, len(links), groups), repr(t)


def test_both_libraries_give_the_same_ids(both):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(f"{crosstok.FOLDER}/{crosstok.BYTE_FILE}")
    tokenizer.encode_special_tokens = True
    texts = [t for t in TEXTS if t] + [LONG[:20_000], "日本語のテキスト、です。 漢字", "ŁÓDŹ i Łomża; Привет мир! Καλημέρα"]
    for t, ids in zip(texts, both[0].encode(texts), strict=True):
        assert ids == tokenizer.encode(" " + t, add_special_tokens=False).ids


def expected(rows, both):
    """Rows of the query by brute force."""
    found = [(r[0], *plain(r[1], both)) for r in rows]
    docs = Counter(p for f in found for p in set(f[4]))
    highest = defaultdict(int)
    for (a, _), n in docs.items():
        highest[a] = max(highest[a], n)
    return sorted(
        (
            (
                i, n_a, n_b, n_groups, len(links), sum(docs[p] == highest[p[0]] for p in links), sum(docs[p] for p in links),
                hashlib.sha256(groups.encode()).hexdigest() if groups else "",
            )
            for i, n_a, n_b, n_groups, links, groups in found
        ),
        key=repr,
    )


@pytest.mark.parametrize("most_pairs", [crosstok.MOST_PAIRS, 25])
def test_counts_over_the_corpus(spark, both, most_pairs):
    rows = [(r[0], r[1]) for r in ODD if r[1] != LONG] + [(100 + i, t) for i, t in enumerate(TEXTS)] + [(7, LONG[:3000])]
    got = crosstok.link_counts(documents(spark, rows), most_pairs=most_pairs)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected(rows, both)


def test_long_text_and_no_rows(spark, both):
    assert crosstok.link_counts(documents(spark, [])).collect() == []
    whole = crosstok.link_counts(documents(spark, [(1, LONG)])).first()
    assert (whole["n_a"], whole["n_b"]) == (len(both[0].encode([LONG])[0]), len(both[1].encode([LONG])[0]))
    assert whole["n_links"] == whole["count_sum"] >= whole["n_best"] > 0


def test_groups_are_kept_for_other_uses(spark, both):
    df = spark.createDataFrame([(1, BASE, "en", "s", 7, *CLASH)], SCHEMA)
    assert crosstok.aligned(df).first()["groups"] == plain(BASE, both)[4]
