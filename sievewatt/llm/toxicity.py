"""Toxicity of whole texts: a lexicon trie met by Levenshtein automata, and hits weighed by their context.

*Lexicon.* Word beginnings that mark toxic texts are learned from one part of the labelled rows: a beginning
is a term if toxic texts hold it in many different contexts and clean ones hardly ever (likelihood ratio), and
it is as long as all words of toxic texts that share it. A term that is a whole word is matched as a word.

*Matching.* The terms form a trie. A word is run through the product of the trie and the Levenshtein automata
of all terms at once: a state is the set of (trie node, edits so far) that are still possible, and states and
their transitions are made when first needed. Terms of 5 letters allow one edit, of 9 letters two. A word that
clean texts use is not a misspelling.

*Context.* A hit counts less within quotation marks, in a line of quoted mail or near a reporting verb, and
more near a second-person word or another hit. All four features are sums of hits so weighed.

*Score.* A logistic model over the weighed hits, fitted on another part of the labelled rows; neither part holds
rows kept back for evaluation. To learn what misspelled and quoted hits are worth, the fit also sees each toxic row with
a letter of its terms doubled, and for each clean row a report that quotes a term, alone or behind the row's text, as
clean. Such made rows weigh :data:`MADE` of a real one.

Labelled rows for training are bounded by :data:`TOXIC_ROWS` and :data:`CLEAN_ROWS` per part, taken in the order
of a hash of the id.

Defined results: null, empty and wordless texts get the score of a text without hits; a null id is not held
out; rows that repeat are scored each; without labelled rows of both classes the lexicon is empty and all
scores are equal; no rows give no rows. Labels that are null or whose document is missing are not used.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievewatt.llm.common import bounded_batches, durable, lean

TOXIC_ROWS = 4000
CLEAN_ROWS = 8000
SHORTEST, LONGEST = 4, 12
# Least log-likelihood ratio and share of toxic contexts for a term; most terms kept.
LEAST_RATIO = 9.0
LEAST_SHARE = 0.8
MOST_TERMS = 20_000
THRESHOLD = 0.7
MADE = 0.25
WINDOW = 6
# States of the automaton kept before it starts anew.
MOST_STATES = 200_000
# Words that a task remembers as matched, and as counted but not yet given out.
MOST_WORDS = 100_000

# Words that tell of someone's words, and words that address someone.
REPORTING = frozenset(
    "said says wrote writes called calls quote quoted quotes reported according sagte schrieb nannte zitat "
    "dit écrit appelé citation dijo escribió llamó cita".split()
)
ADDRESS = frozenset("you your yours u du dich dir dein ihr euch tu toi te vous votre ton tú usted tus".split())

# Digits within a word belong to it, so that one in a letter's place is an edit.
WORD = re.compile(r"[^\W\d_]+(?:\d+[^\W\d_]+)*")
QUOTES = re.compile("[\"“”„«»]")


def edits_of(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


@dataclass
class Lexicon:
    """Terms, whether each is a whole word, their weights, and words that are no misspellings."""

    terms: list[str]
    whole: list[bool]
    weights: list[float]
    usual: frozenset[str] = frozenset()


class Matcher:
    """The product of the lexicon's trie with the Levenshtein automata of its terms, made on demand."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[int] = [-1]
        self.room: list[int] = [0]  # most edits that any term below allows
        for i, term in enumerate(lexicon.terms):
            at, allowed = 0, edits_of(term)
            self.room[0] = max(self.room[0], allowed)
            for ch in term:
                nxt = self.children[at].get(ch)
                if nxt is None:
                    nxt = self.children[at][ch] = len(self.children)
                    self.children.append({})
                    self.ends.append(-1)
                    self.room.append(0)
                at = nxt
                self.room[at] = max(self.room[at], allowed)
            self.ends[at] = i
        self._reset()

    def _reset(self) -> None:
        self.ids: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.next: dict[tuple[int, str], int] = {}
        self.start = self._state({0: 0}, None)

    def _state(self, nodes: dict[int, int], found: tuple[int, int] | None) -> int:
        """The state for the least edits per node, after letters of terms have been left out."""
        todo = list(nodes)
        while todo:
            node = todo.pop()
            for child in self.children[node].values():
                edits = nodes[node] + 1
                if edits <= self.room[child] and edits < nodes.get(child, 99):
                    nodes[child] = edits
                    todo.append(child)
        for node, edits in nodes.items():  # a beginning is found as soon as it is complete
            i = self.ends[node]
            if i >= 0 and not self.lexicon.whole[i] and edits <= edits_of(self.lexicon.terms[i]):
                if found is None or (edits, i) < found:
                    found = (edits, i)
        key = (frozenset(nodes.items()), found)
        if key not in self.ids:
            self.ids[key] = len(self.states)
            self.states.append((nodes, found))
        return self.ids[key]

    def _step(self, state: int, ch: str) -> int:
        nodes, found = self.states[state]
        out: dict[int, int] = {}
        for node, edits in nodes.items():
            more = edits + 1
            if more <= self.room[node]:  # a letter too many
                out[node] = min(out.get(node, 99), more)
            for letter, child in self.children[node].items():
                cost = edits if letter == ch else more
                if cost <= self.room[child]:
                    out[child] = min(out.get(child, 99), cost)
        return self._state(out, found)

    def match(self, word: str) -> tuple[int, int] | None:
        """(edits, term) of the best term for the word."""
        if len(self.states) > MOST_STATES:
            self._reset()
        at = self.start
        for ch in word:
            key = (at, ch)
            nxt = self.next.get(key)
            if nxt is None:
                nxt = self.next[key] = self._step(at, ch)
            at = nxt
            if not self.states[at][0]:
                break
        nodes, found = self.states[at]
        for node, edits in nodes.items():
            i = self.ends[node]
            if i >= 0 and edits <= edits_of(self.lexicon.terms[i]) and (found is None or (edits, i) < found):
                found = (edits, i)
        if found and found[0] and word in self.lexicon.usual:
            return None
        return found


@dataclass
class Reader:
    """Turns texts into features; words seen before are looked up, not matched again."""

    lexicon: Lexicon
    matcher: Matcher = field(init=False)
    hits: dict[str, tuple[int, int]] = field(default_factory=dict)
    clean: set[str] = field(default_factory=set)

    def __post_init__(self) -> None:
        self.matcher = Matcher(self.lexicon)

    def features(self, text: str | None) -> tuple[tuple[float, float, float, float], list[str]]:
        """Exact hits, distinct terms, misspelled hits and density, each weighed by context; the terms found."""
        lower = (text or "").lower()
        words = WORD.findall(lower)
        distinct = set(words)
        if len(self.hits) > MOST_WORDS:
            self.hits.clear()
        for w in distinct - self.clean - self.hits.keys():
            found = self.matcher.match(w)
            if found:
                self.hits[w] = found
            else:
                self.clean.add(w)
        if len(self.clean) > MOST_WORDS:
            self.clean.clear()
        if not distinct & self.hits.keys():
            return (0.0, 0.0, 0.0, 0.0), []
        exact = fuzzy = dense = 0.0
        terms: dict[str, float] = {}
        places = [i for i, w in enumerate(words) if w in self.hits]
        quoted = _quoted(lower, places)
        for n, i in enumerate(places):
            edits, term = self.hits[words[i]]
            around = words[max(0, i - WINDOW) : i] + words[i + 1 : i + 1 + WINDOW]
            factor = 0.35 if quoted[n] else 1.0
            if not REPORTING.isdisjoint(around):
                factor *= 0.6
            if not ADDRESS.isdisjoint(around):
                factor *= 1.25
            if any(w in self.hits for w in around):
                factor *= 1.1
            weight = self.lexicon.weights[term] * factor
            dense += factor
            if edits:
                fuzzy += weight * 0.8**edits
            else:
                exact += weight
                name = self.lexicon.terms[term]
                terms[name] = max(factor, terms.get(name, 0.0))
        density = 100.0 * dense / len(words)
        return (np.log1p(exact), np.log1p(sum(terms.values())), np.log1p(fuzzy), np.log1p(density)), sorted(terms)

    def misspelled(self, text: str) -> str | None:
        """The text with a letter doubled in every term that allows an edit; nothing if it holds none."""
        self.features(text)

        def double(m: re.Match) -> str:
            edits, term = self.hits.get(m[0].lower(), (1, 0))
            name = self.lexicon.terms[term]
            if edits or not edits_of(name):
                return m[0]
            at = len(name) // 2
            return m[0][:at] + m[0][at] + m[0][at:]

        out = WORD.sub(double, text)
        return None if out == text else out

    def quoting(self, text: str) -> str:
        """A report that quotes a term, alone or behind the text; which term and which of both follows from the text."""
        n = xxhash.xxh64_intdigest(text)
        term = self.lexicon.terms[n // 2 % len(self.lexicon.terms)]
        report = f'In the report she said that "{term}" was the word they had used.'
        return report if n % 2 else f"{text}\n{report}"


def _quoted(lower: str, places: list[int]) -> list[bool]:
    """For each hit (by number of word): whether it is in quotation marks on its line, or in a quoted line."""
    out, wanted, n = [], iter(places), 0
    want = next(wanted)
    for line in lower.split("\n"):
        words = list(WORD.finditer(line))
        while want is not None and want < n + len(words):
            before = line[: words[want - n].start()]
            opened = len(QUOTES.findall(before)) % 2 == 1
            closed = opened and QUOTES.search(line[words[want - n].end() :]) is not None
            out.append(closed or line.lstrip().startswith(">"))
            want = next(wanted, None)
        n += len(words)
    return out


def crc_part(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % 3, F.lit(0))


@dataclass
class Model:
    lexicon: Lexicon
    bias: float
    coefficients: tuple[float, ...]

    def score(self, features: Iterable[float]) -> float:
        z = self.bias + sum(c * x for c, x in zip(self.coefficients, features, strict=True))
        return float(1 / (1 + np.exp(-min(60.0, max(-60.0, z)))))


def _sampled(labels: DataFrame, part: int, id_col: str, label_col: str, rows: tuple[int, int]) -> DataFrame:
    """(id, y) of a bounded number of labelled rows of each class, in the order of a hash."""
    known = (
        labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (crc_part(F.col(id_col)) == part))
        .groupBy(F.col(id_col).cast("long").alias("id"))
        .agg(F.max(F.col(label_col).cast("int")).alias("y"))
    )
    take = [known.filter(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(n) for y, n in enumerate(rows)]
    return take[0].unionByName(take[1])


def _words_used(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, toxic, clean, context): contexts of words in toxic texts, numbers of clean texts with a word."""
    clean: dict[str, int] = {}
    for batch in batches:
        rows: dict[str, list] = {"word": [], "context": []}
        for text, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist(), strict=True):
            words = WORD.findall((text or "").lower())
            if not y:
                for w in set(words):
                    clean[w] = clean.get(w, 0) + 1
                continue
            for i, w in enumerate(words):
                if len(w) >= SHORTEST:
                    rows["word"].append(w)
                    rows["context"].append(xxhash.xxh64_intdigest(" ".join(words[max(0, i - 1) : i + 2])) >> 1)
        yield _used(rows["word"], [0] * len(rows["word"]), rows["context"])
        if len(clean) > MOST_WORDS:
            yield _used(list(clean), list(clean.values()), [None] * len(clean))
            clean.clear()
    yield _used(list(clean), list(clean.values()), [None] * len(clean))


def _used(word: list, clean: list, context: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {"word": pa.array(word, pa.string()), "clean": pa.array(clean, pa.int64()), "context": pa.array(context, pa.int64())}
    )


def learn_terms(texts: DataFrame) -> Lexicon:
    """The lexicon from labelled ``texts`` (text, y)."""
    used = texts.mapInArrow(lean(_words_used), "word string, clean long, context long")
    # a context that several near copies share counts once
    words = durable(
        used.groupBy("word").agg(F.countDistinct("context").alias("toxic"), F.sum("clean").alias("clean"))
    )
    sizes = words.agg(F.sum("toxic"), F.sum("clean")).first()
    if not sizes[0] or not sizes[1]:
        return Lexicon([], [], [])
    base = sizes[0] / (sizes[0] + sizes[1])
    marking = words.filter(F.length("word") >= SHORTEST)
    starts = F.transform(
        F.sequence(F.lit(SHORTEST), F.least(F.length("word"), F.lit(LONGEST))), lambda n: F.substr("word", F.lit(1), n)
    )
    # only beginnings that some toxic text has; the others cannot qualify
    begins = marking.select(F.explode(starts).alias("start"), "toxic", "clean")
    counts = begins.groupBy("start").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    total = F.col("toxic") + F.col("clean")
    ratio = F.col("toxic") * F.log(F.col("toxic") / (total * F.lit(base)))
    terms = (
        counts.filter((F.col("toxic") > 2) & (F.col("toxic") >= LEAST_SHARE * total) & (ratio >= LEAST_RATIO))
        .orderBy(F.desc("toxic"), "start")
        .limit(MOST_TERMS)
    )
    found = {r["start"]: (r["toxic"], r["clean"]) for r in terms.collect()}
    kept: dict[str, tuple[bool, float]] = {}
    for start in sorted(found, key=lambda s: (len(s), s)):
        if any(start[:n] in found for n in range(SHORTEST, len(start))):
            continue
        longest = start
        while True:  # as long as all its toxic words share it
            more = [s for s in (longest + c for c in _letters(found, longest)) if s in found and found[s][0] == found[start][0]]
            if not more:
                break
            longest = more[0]
        toxic, clean = found[start]
        kept[longest] = (False, float(np.log((toxic + 0.5) / (clean + 0.5) * (1 - base) / base)))
    names = sorted(kept)
    exact = {
        r["word"]: r["toxic"]
        for r in words.join(F.broadcast(texts.sparkSession.createDataFrame([(t,) for t in names] or [("",)], "word string")), "word").collect()
    }
    # a whole word: nearly all of the term's uses are the term itself
    whole = [exact.get(t, 0) >= 0.9 * found.get(t, (10**9, 0))[0] if len(t) < LONGEST else t in exact for t in names]
    lexicon = Lexicon(names, whole, [min(6.0, kept[t][1]) for t in names])
    return Lexicon(lexicon.terms, lexicon.whole, lexicon.weights, _usual(words, lexicon))


def _letters(found: dict[str, tuple[int, int]], start: str) -> set[str]:
    return {s[len(start)] for s in found if len(s) == len(start) + 1 and s.startswith(start)}


def _usual(words: DataFrame, lexicon: Lexicon) -> frozenset[str]:
    """Words of clean texts that a misspelled term could be taken for."""
    shipped = words.sparkSession.sparkContext.broadcast(lexicon)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(shipped.value)
        for batch in batches:
            out = [w for w in batch.column("word").to_pylist() if (m := matcher.match(w)) and m[0]]
            yield pa.RecordBatch.from_pydict({"word": pa.array(out, pa.string())})

    seen = words.filter(F.col("clean") > 0).select("word").mapInArrow(lean(near, 10_000), "word string")
    return frozenset(r[0] for r in seen.orderBy("word").limit(1_000_000).collect())


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.5, steps: int = 40) -> tuple[float, tuple[float, ...]]:
    """Logistic regression by Newton's method; coefficients are kept from falling below zero."""
    a = np.column_stack((np.ones(len(x)), x))
    w, held = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    penalty = np.r_[1e-3, np.full(a.shape[1] - 1, ridge)]
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (weight * (p - y)) + penalty * w
        hess = (a * (weight * p * (1 - p))[:, None]).T @ a + np.diag(penalty)
        free = ~held
        step = np.zeros_like(w)
        step[free] = np.linalg.solve(hess[np.ix_(free, free)], grad[free])
        w = w - np.clip(step, -4, 4)
        held = np.r_[False, w[1:] < 0]
        w[held] = 0.0
        if np.abs(step[~held]).max() < 1e-6:
            break
    return float(w[0]), tuple(float(c) for c in w[1:])


def _features(lexicon) -> object:
    """(y, weight, x) of labelled texts and of the rows made from them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(lexicon.value)
        for batch in batches:
            out: dict[str, list] = {"y": [], "weight": [], "x": []}
            for text, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist(), strict=True):
                made = None
                if text and reader.lexicon.terms:
                    made = reader.misspelled(text) if y else reader.quoting(text)
                for t, weight in ((text, 1.0), (made, MADE)) if made else ((text, 1.0),):
                    out["y"].append(y)
                    out["weight"].append(weight)
                    out["x"].append(list(reader.features(t)[0]))
            yield pa.RecordBatch.from_pydict(
                {"y": pa.array(out["y"], pa.int32()), "weight": pa.array(out["weight"], pa.float64()), "x": pa.array(out["x"], pa.list_(pa.float64()))}
            )

    return run


def train(
    docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", label_col: str = "toxic",
    rows: tuple[int, int] = (CLEAN_ROWS, TOXIC_ROWS),
) -> Model:
    """Terms from labelled rows whose crc32 of the id leaves 0 by three, the model from those that leave 2."""
    spark = docs.sparkSession
    bounded_batches(spark)
    chosen = _sampled(labels, 0, id_col, label_col, rows).withColumn("part", F.lit(0)).unionByName(
        _sampled(labels, 2, id_col, label_col, rows).withColumn("part", F.lit(2))
    )
    wanted = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    # at most two parts of sum(rows) ids
    texts = durable(wanted.join(F.broadcast(chosen), "id").select("text", "y", "part"))
    lexicon = learn_terms(texts.filter("part = 0").select("text", "y"))
    shipped = spark.sparkContext.broadcast(lexicon)
    made = texts.filter("part = 2").select("text", "y").mapInArrow(lean(_features(shipped)), "y int, weight double, x array<double>").collect()
    y, share = np.array([r["y"] for r in made], float), np.array([r["weight"] for r in made], float)
    if not lexicon.terms or not 0 < y.sum() < len(y):
        real = y[share == 1.0]
        return Model(lexicon, 0.0 if not len(y) else float(np.log((real.sum() + 1) / (len(real) - real.sum() + 1))), (0.0,) * 4)
    shares = labels.filter(crc_part(F.col(id_col)) == 2).groupBy(F.col(label_col).cast("int").alias("y")).count().collect()
    full = {r["y"]: r["count"] for r in shares}
    real = share == 1.0
    per_class = np.array([full[n] / max(1, (real & (y == n)).sum()) for n in (0, 1)])
    weight = per_class[y.astype(int)] * share
    return Model(lexicon, *fit(np.array([r["x"] for r in made]), y, weight / weight.mean()))


def score(docs: DataFrame, model: Model, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, score, terms) for every row of ``docs``."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(shipped.value.lexicon)
        for batch in batches:
            made = [reader.features(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict(
                {
                    "id": batch.column("id"),
                    "score": pa.array([shipped.value.score(x) for x, _ in made], pa.float64()),
                    "terms": pa.array([",".join(t) for _, t in made], pa.string()),
                }
            )

    wanted = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return wanted.mapInArrow(lean(run), "id long, score double, terms string")


def without_toxic(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score is below ``threshold``, with all their columns."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(shipped.value.lexicon)
        for batch in batches:
            scores = [shipped.value.score(reader.features(t)[0]) for t in batch.column(text_col).to_pylist()]
            yield batch.filter(pa.array([s < threshold for s in scores], pa.bool_()))

    return docs.mapInArrow(lean(run), docs.schema)
