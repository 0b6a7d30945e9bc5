"""Main text of web pages: a linear-chain conditional random field over the pages' leaf blocks.

A page is cut into tags and text in one pass, open elements are kept on a stack, and text between two block
boundaries is a leaf block with what features need of its ancestors' tags and classes and the share of its text that is
linked. An element hands on to those inside it the sets it was given, or larger ones if it adds to them; both are bounded by
the lists below, so that time and memory grow with a page's length however deep it is nested. Each block gets features
from these and from its text. The field has two labels (main text or not), a weight per
feature and label and one per pair of neighbouring labels. It is trained on labelled pages by maximum likelihood
(forward-backward, gradient steps) and decoded by Viterbi.

Labelled pages are those whose markup says what is what (``article`` or ``main`` without the parts named in
:data:`OUTSIDE`); :data:`TRAINING_PAGES` of them are used, chosen by a hash of the id. For half of these the
features of the two elements are withheld, so that the rest learns to do without them.

Defined results: null, empty and textless pages have an empty text; unclosed elements end with the one around
them; a stray end tag is ignored; an unclosed comment, script or style runs to the end; repeated rows are
extracted each; without labelled pages the markup's own rule decides; no rows give no rows.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewatt.llm.common import durable

TRAINING_PAGES = 400
# Blocks of a page that are used for training (all are decoded).
TRAINING_BLOCKS = 512

# Names of elements and of what surrounds main texts.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hr html label legend li main nav ol option p pre section select summary table "
    "tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - frozenset("body button head html label legend option select caption".split())
OUTSIDE = frozenset("nav header footer aside form script style noscript template iframe svg button select dialog head menu".split())
MARKS = frozenset(
    "ad ads advert advertisement adverts banner comment comments cookie footer header menu nav navbar navigation "
    "newsletter notice popup promo related share sharing sidebar social sponsor sponsored subscribe widget disqus "
    "responses breadcrumb breadcrumbs consent alert".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form menu alert dialog".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*+)>|<[!?][^>]*+>",
    re.S,
)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+)", re.I)
NAME = re.compile(r"[a-z]+")


# Ancestors that features ask for, wherever they are.
TOLD = OUTSIDE | frozenset("article main ul ol table blockquote figure pre".split())
MAIN = frozenset(("article", "main"))


@dataclass(frozen=True, slots=True)
class Element:
    """An open element: its tag, and of it and its ancestors the tags in :data:`TOLD`, the marks, and the innermost block."""

    tag: str = ""
    held: frozenset[str] = frozenset()
    marks: frozenset[str] = frozenset()
    inner: str = "none"

    def child(self, tag: str, names: set[str]) -> Element:
        held = self.held if tag not in TOLD or tag in self.held else self.held | {tag}
        marks = self.marks if names <= self.marks else self.marks | names
        return Element(tag, held, marks, tag if tag in BLOCK else self.inner)


@dataclass(slots=True)
class Block:
    text: str
    around: Element
    linked: float


def blocks(page: str | None) -> list[Block]:
    """The leaf blocks of a page, in order, with decoded text and single spaces."""
    page = page or ""
    stack = [Element()]
    opened: Counter[str] = Counter()
    out: list[Block] = []
    parts: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            raw = "".join(parts)
            text = " ".join((html.unescape(raw) if "&" in raw else raw).split())
            if text:
                out.append(Block(text, stack[-1], min(1.0, linked / len(text))))
            parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        parts.append(text)
        if opened["a"]:
            linked += len(text)

    def close(tag: str) -> None:
        while opened[tag]:
            last = stack.pop().tag
            opened[last] -= 1
            if last == tag:
                return

    at = 0
    while m := TOKEN.search(page, at):
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            if tag in BLOCK:
                flush()
            close(tag)
            continue
        if tag in BLOCK:
            flush()
            if tag in CLOSES_P and opened["p"]:
                close("p")
            if tag in ("li", "dt", "dd", "tr", "td", "th", "option") and stack[-1].tag == tag:
                close(tag)
        if tag == "br":
            parts.append(" ")
        rest = m[3] or m[6] or ""
        if tag in VOID or rest.endswith("/") and tag not in BLOCK:
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        names: set[str] = set()
        for name, value in ATTRIBUTE.findall(rest) if "=" in rest else ():
            own = NAME.findall(value.lower())
            names.update("role " + n for n in own if n in ROLES) if name.lower() == "role" else names.update(n for n in own if n in MARKS)
        stack.append(stack[-1].child(tag, names))
        opened[tag] += 1
    if at < len(page):
        add(page[at:])
    flush()
    return out


def labelled(page: list[Block]) -> list[int] | None:
    """What the markup itself says about each block; nothing if it has no element for the main text."""
    around = [b.around for b in page]
    if all(MAIN.isdisjoint(e.held) for e in around):
        return None
    return [int(not MAIN.isdisjoint(e.held) and not e.marks and OUTSIDE.isdisjoint(e.held)) for e in around]


def features(page: list[Block], told: bool = True) -> list[list[str]]:
    """Names of the features that hold for each block; ``told``: with those of ``article`` and ``main``."""
    out = []
    for i, b in enumerate(page):
        n, e = len(b.text), b.around
        own = ["any", f"length {min(6, n.bit_length() - 4) if n >= 16 else 0}", f"linked {int(b.linked * 3.99)}"]
        own += ["has " + t for t in e.held - MAIN]
        if told and not MAIN.isdisjoint(e.held):
            own.append("has article")
        own.append("in " + e.inner)
        own += ["mark " + m for m in e.marks]
        if e.marks or not OUTSIDE.isdisjoint(e.held):
            own.append("outside")
        if b.text[-1] in ".!?…\"”»)":
            own.append("ends a sentence")
        if "©" in b.text or "|" in b.text:
            own.append("sign")
        if i == 0 or i == len(page) - 1:
            own.append("first" if i == 0 else "last")
        out.append(own)
    return out


@dataclass
class Field:
    """Scores: per feature for label 1 against 0, and per pair of labels."""

    weights: dict[str, float]
    steps: np.ndarray

    def decode(self, page: list[list[str]]) -> list[int]:
        get = self.weights.get
        (s00, s01), (s10, s11) = self.steps.tolist()
        back, a, b = [], 0.0, 0.0
        for i, own in enumerate(page):
            e = 0.0
            for f in own:
                e += get(f, 0.0)
            if i:
                from0, from1 = a + s00 < b + s10, a + s01 < b + s11
                back.append((int(from0), int(from1)))
                a, b = (b + s10 if from0 else a + s00), (b + s11 if from1 else a + s01)
            b += e
        if not page:
            return []
        out = [int(b > a)]
        for step in reversed(back):
            out.append(step[out[-1]])
        return out[::-1]


def fit(pages: list[tuple[list[list[str]], list[int]]], rounds: int = 150, ridge: float = 1e-3) -> Field:
    """Maximum likelihood with a small ridge, all pages at once, by sign-adapted gradient steps (Rprop)."""
    names = sorted({f for x, _ in pages for own in x for f in own})
    index = {f: i for i, f in enumerate(names)}
    longest = max(len(y) for _, y in pages)
    shape = (longest, len(pages))
    x = np.zeros((*shape, len(names)), np.float32)
    y = np.zeros(shape, int)
    there = np.zeros(shape, bool)
    for p, (own, label) in enumerate(pages):
        there[: len(label), p] = True
        y[: len(label), p] = label
        for t, names_t in enumerate(own):
            x[t, p, [index[f] for f in names_t]] = 1
    flat, on = x.reshape(-1, len(names)), there.reshape(-1)
    flat = flat[on]
    w, steps = np.zeros(len(names)), np.zeros((2, 2))
    size, last = np.full(len(names) + 4, 0.1), np.zeros(len(names) + 4)
    pair = there[1:]
    seen = np.array([[((y[:-1] == i) & (y[1:] == j) & pair).sum() for j in (0, 1)] for i in (0, 1)], float)
    for _ in range(rounds):
        e = np.zeros((*shape, 2))
        e[there, 1] = flat @ w
        forward, backward = e.copy(), np.zeros_like(e)
        for t in range(1, longest):
            step = np.logaddexp(forward[t - 1, :, :1] + steps[0], forward[t - 1, :, 1:] + steps[1])
            forward[t] = np.where(there[t][:, None], step + e[t], forward[t - 1])
        for t in range(longest - 2, -1, -1):
            ahead = backward[t + 1] + e[t + 1]
            step = np.logaddexp(ahead[:, :1] + steps[:, 0], ahead[:, 1:] + steps[:, 1])
            backward[t] = np.where(there[t + 1][:, None], step, 0.0)
        total = np.logaddexp(forward[-1, :, 0], forward[-1, :, 1])
        one = np.exp(forward[..., 1] + backward[..., 1] - total)
        grad_w = flat.T @ (y[there] - one[there]) - ridge * len(flat) * w
        grad_s = np.zeros((2, 2))
        for i in (0, 1):
            for j in (0, 1):
                both = np.exp(forward[:-1, :, i] + steps[i, j] + e[1:, :, j] + backward[1:, :, j] - total)
                grad_s[i, j] = seen[i, j] - both[pair].sum()
        grad = np.r_[grad_w, (grad_s - ridge * len(flat) * steps).ravel()]
        agree = np.sign(grad) * np.sign(last)
        size = np.clip(np.where(agree > 0, size * 1.2, np.where(agree < 0, size * 0.5, size)), 1e-5, 1.0)
        last = np.where(agree < 0, 0.0, grad)
        move = np.sign(last) * size
        w, steps = w + move[:-4], steps + move[-4:].reshape(2, 2)
    return Field({f: float(w[i]) for f, i in index.items()}, steps)


def train(pages: DataFrame, html_col: str = "html", id_col: str = "page_id", most: int = TRAINING_PAGES) -> Field | None:
    """Fit the field on at most ``most`` labelled pages."""
    keyed = pages.select(F.xxhash64(F.col(id_col)).alias("h"), F.col(html_col).alias("html")).filter("html IS NOT NULL")
    chosen = keyed.filter(F.lower("html").rlike("<(article|main)[\\s>]")).select("h").orderBy("h").limit(most)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xs, ys = [], []
            for h, page in zip(batch.column("h").to_pylist(), batch.column("html").to_pylist(), strict=True):
                made = blocks(page)[:TRAINING_BLOCKS]
                label = labelled(made)
                if label:
                    xs.append(features(made, told=h % 2 == 0))
                    ys.append(label)
            yield pa.RecordBatch.from_pydict(
                {"x": pa.array(xs, pa.list_(pa.list_(pa.string()))), "y": pa.array(ys, pa.list_(pa.int32()))}
            )

    wanted = keyed.join(F.broadcast(durable(chosen.distinct())), "h")
    found = wanted.mapInArrow(read, "x array<array<string>>, y array<int>").limit(2 * most).collect()
    return fit([(r["x"], r["y"]) for r in found]) if found else None


def main_text(page: str | None, field: Field | None) -> str:
    made = blocks(page)
    label = field.decode(features(made)) if field else labelled(made) or [0] * len(made)
    return "\n".join(b.text for b, y in zip(made, label, strict=True) if y)


def extract(pages: DataFrame, field: Field | None, html_col: str = "html", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id, url, text) for every row of ``pages``."""
    shipped = pages.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p, shipped.value) for p in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("url").cast(pa.string()), pa.array(texts, pa.string())], ["id", "url", "text"]
            )

    wanted = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return wanted.mapInArrow(run, "id long, url string, text string")
