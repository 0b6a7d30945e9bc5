"""Matching against plain edit distances, held-out accuracy, context, and awkward rows."""

import random
import zlib

import numpy as np
from rows import ODD, documents

from sievewatt.llm import toxicity
from sievewatt.llm.toxicity import Lexicon, Matcher, Reader

SYLLABLES = "ba ke lo mi nu ra so ti ve zo pa du".split()


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def plain_match(word, lexicon):
    best = None
    for i, term in enumerate(lexicon.terms):
        heads = [word] if lexicon.whole[i] else [word[:n] for n in range(len(word) + 1)]
        edits = min(distance(h, term) for h in heads)
        if edits <= toxicity.edits_of(term) and (best is None or (edits, i) < best):
            best = (edits, i)
    return best


def test_automata_agree_with_plain_distances():
    rng = random.Random(1)
    terms = sorted({"".join(rng.choice(SYLLABLES) for _ in range(rng.randint(2, 5))) for _ in range(25)})
    lexicon = Lexicon(terms, [i % 3 != 0 for i in range(len(terms))], [1.0] * len(terms))
    matcher = Matcher(lexicon)
    for _ in range(2500):
        word = list(rng.choice(terms))
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(word) + 1)
            word[at : at + rng.randint(0, 1)] = rng.choice(["", rng.choice("abekorz")])
        word = "".join(word)
        found, plain = matcher.match(word), plain_match(word, lexicon)
        assert (found and found[0]) == (plain and plain[0]), word


def test_usual_words_are_no_misspellings():
    lexicon = Lexicon(["moron"], [True], [3.0], frozenset(["boron"]))
    assert Matcher(lexicon).match("boron") is None
    assert Matcher(lexicon).match("morron") == (1, 0)


def test_quoted_hits_count_less():
    reader = Reader(Lexicon(["moron", "idiot"], [True, True], [3.0, 3.0]))
    told = reader.features("and then he is a moron they think")[0][0]
    quoted = reader.features('the word "moron" is old')[0][0]
    reported = reader.features('she said that "moron" was used')[0][0]
    direct = reader.features("you are a moron")[0][0]
    assert reported < quoted < told < direct
    assert reader.features("> moron here")[0][0] == quoted
    assert reader.features(None) == reader.features("") == ((0.0, 0.0, 0.0, 0.0), [])


def test_made_rows():
    reader = Reader(Lexicon(["moron", "scum"], [True, True], [3.0, 3.0]))
    assert reader.misspelled("A MORON, scum and a m0ron") == "A MORRON, scum and a m0ron"
    assert reader.misspelled("scum") is None and reader.misspelled("none here") is None
    assert Matcher(reader.lexicon).match("m0ron") == (1, 0) and toxicity.WORD.findall("a m0ron2 4x") == ["a", "m0ron", "x"]
    for text in ("first", "second", "third", "fourth text"):
        made = reader.quoting(text)
        assert made == reader.quoting(text) and 0 < reader.features(made)[0][0] < np.log1p(3.0 * 0.35)
    dense = reader.features("moron " + "word " * 9)[0][3]
    assert reader.features('"moron" ' + "word " * 9)[0][3] < dense == np.log1p(10.0)


def corpus(n=900, seed=2):
    """Labelled texts whose toxic ones hold at least two of the marking words, sometimes as new forms of a stem."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4)))
    rows, labels = [], []
    for i in range(n):
        text = [word() for _ in range(rng.randint(20, 90))]
        toxic = i % 6 == 0
        for _ in range(rng.randint(2, 6) if toxic else 0):
            text.insert(rng.randrange(len(text)), rng.choice(["stinker", "wretch", "gloxy" + word()]))
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic), 1))
    return rows, labels


def test_held_out_accuracy_and_stages(spark):
    rows, labels = corpus()
    docs = documents(spark, rows)
    known = spark.createDataFrame([*labels, (None, 1, 0), (3, None, 0), (10**9, 1, 0)], "doc_id long, toxic int, quality int")
    model = toxicity.train(docs, known)
    assert {"stinker", "wretch", "gloxy"} <= set(model.lexicon.terms)
    got = {r["id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    held = [(i, y) for i, y, _ in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum((got[i] >= toxicity.THRESHOLD) == bool(y) for i, y in held) >= 0.97 * len(held)
    assert model.score(Reader(model.lexicon).features("a wretchh and a stinkker are you")[0]) > model.score([0.0] * 4)
    read = lambda text: model.score(Reader(model.lexicon).features(text)[0])
    assert model.coefficients[2] > 0
    assert read('He said that "stinker" was the word in the report') < toxicity.THRESHOLD <= read("you are a stinker.")
    harmless = " " + " ".join(r[1] for r in rows[1:4])
    assert read("You are a stinker, a wretch!" + harmless) >= toxicity.THRESHOLD > read('They wrote "stinker" on it.' + harmless)
    assert read("you stinkker, you st1nker" + harmless) >= toxicity.THRESHOLD
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, s in got.items() if s < toxicity.THRESHOLD}


def test_awkward_rows(spark):
    rows, labels = corpus(120)
    known = spark.createDataFrame(labels, "doc_id long, toxic int, quality int")
    model = toxicity.train(documents(spark, rows), known)
    got = toxicity.score(documents(spark, ODD), model).collect()
    assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.score(documents(spark, []), model).collect() == []
    for none in (known.limit(0), known.filter("toxic = 0")):
        blank = toxicity.train(documents(spark, rows), none)
        assert len({r["score"] for r in toxicity.score(documents(spark, ODD), blank).collect()}) == 1
