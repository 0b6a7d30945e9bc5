"""Block reading, the field's likelihood and decoding against enumeration, and extraction."""

import itertools
import time
import tracemalloc

import numpy as np

from sievewatt.llm import htmltext

PAGE = (
    "<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var t=\"</p>\";</script></head><body>"
    "<header>Site name</header><nav><ul><li><a href='/x'>One</a></li><li><a href=\"a>b\">Two</a></li></ul></nav><!-- <p>no</p> -->"
    "<div class=\"ad\">Buy now, {i}.</div><article><h1>Title {i} &amp; more</h1><p>First &lt;b&gt; text\n  goes\t on,<br>here.<p>Second {i} <i>text</i>.</p>"
    "<aside>Related things</aside><section class='comments'><p>I like it.</p></section></article><footer>&copy; 2020 {i}</footer>"
)


def page(i):
    return PAGE.replace("{i}", str(i))


def want(i):
    return f"Title {i} & more\nFirst <b> text goes on, here.\nSecond {i} text."


def test_blocks():
    texts = [b.text for b in htmltext.blocks(page(3))]
    assert texts == ["Site name", "One", "Two", "Buy now, 3.", *want(3).split("\n"), "Related things", "I like it.", "© 2020 3"]
    for odd in (None, "", "<", "<p", "<!-- open", "</p></div>", "<script>x", "a<br>b", "&am &amp x", "<p class='a", "<a href=\"x>y"):
        assert all(b.text for b in htmltext.blocks(odd))
    assert [b.text for b in htmltext.blocks("a<br>b &am &amp x<p>c")] == ["a b &am & x", "c"]
    assert len(htmltext.blocks("<div>" * 2000 + "<p>x" * 3000)) == 3000


def test_deep_nesting_takes_memory_and_time_in_proportion():
    def peak(n):
        tracemalloc.start()
        start = time.process_time()
        got = htmltext.blocks("<article>" + "<div class='ad'><b>x " * n + "</p></i>" * n)
        took, most = time.process_time() - start, tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert len(got) == n and got[-1].around.marks == {"ad"} and got[-1].around.held == {"article"}
        return took, most

    (_, small), (took, large) = peak(2_000), peak(20_000)
    assert large < 12 * small and large < 50_000_000 and took < 20


def test_what_a_block_knows_of_its_ancestors():
    got = htmltext.blocks("<main><ul><li>a<li><a href=x>b</a></ul><table><tr><td class='x promo'>c<td>d</table><p>e<div role=search>f</div>g</main>h")
    assert [(b.text, sorted(b.around.held), sorted(b.around.marks), b.around.inner, b.linked) for b in got] == [
        ("a", ["main", "ul"], [], "li", 0.0),
        ("b", ["main", "ul"], [], "li", 1.0),
        ("c", ["main", "table"], ["promo"], "td", 0.0),
        ("d", ["main", "table"], [], "td", 0.0),
        ("e", ["main"], [], "p", 0.0),
        ("f", ["main"], ["role search"], "div", 0.0),
        ("g", ["main"], [], "main", 0.0),
        ("h", [], [], "none", 0.0),
    ]


def total_score(field, page_features, labels):
    e = sum(sum(field.weights.get(f, 0.0) for f in own) for own, y in zip(page_features, labels, strict=True) if y)
    return e + sum(field.steps[a, b] for a, b in itertools.pairwise(labels))


def test_viterbi_is_the_best_of_all_paths():
    rng = np.random.default_rng(5)
    for n in (1, 2, 5, 8):
        field = htmltext.Field({f"f{i}": float(w) for i, w in enumerate(rng.normal(size=6))}, rng.normal(size=(2, 2)))
        own = [[f"f{j}" for j in rng.integers(0, 6, 2)] for _ in range(n)]
        best = max(itertools.product((0, 1), repeat=n), key=lambda y: total_score(field, own, y))
        assert tuple(field.decode(own)) == best


def test_training_raises_the_likelihood_of_the_labels():
    pages = [htmltext.blocks(page(i)) for i in range(6)]
    data = [(htmltext.features(p), htmltext.labelled(p)) for p in pages]
    field = htmltext.fit(data)
    own, y = data[0]
    all_paths = [total_score(field, own, z) for z in itertools.product((0, 1), repeat=len(own))]
    share = np.exp(total_score(field, own, y) - np.logaddexp.reduce(all_paths))
    assert share > 0.9 and field.decode(own) == y


def test_extraction(spark):
    rows = [(i, f"http://x/{i}", page(i)) for i in range(40)]
    odd = [(50, None, None), (51, "u", ""), (None, "u", page(51)), (3, "u", page(3)), (52, "u", page(52).replace("<article>", "<div>").replace("</article>", "</div>"))]
    schema = "page_id long, url string, html string, text string, h long, x string"
    pages = spark.createDataFrame([(*r, "t", 1, "x") for r in rows + odd], schema)
    field = htmltext.train(pages)
    got = [(r["id"], r["text"]) for r in htmltext.extract(pages, field).collect()]
    assert sorted(map(repr, got)) == sorted(
        map(repr, [(i, want(i)) for i in range(40)] + [(50, ""), (51, ""), (None, want(51)), (3, want(3)), (52, want(52))])
    )
    assert htmltext.train(pages.limit(0)) is None
    assert htmltext.extract(pages.limit(0), None).count() == 0
    assert htmltext.extract(pages.filter("page_id = 7"), None).first()["text"] == want(7)
