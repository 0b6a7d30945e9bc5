"""The URL filter against a plain loop over the rules."""

import numpy as np
import pytest
import xxhash

from sievewatt.llm import urlfilter
from sievewatt.llm.registry import URL_RULES

URLS = [
    None, "", "no scheme", "http://", "https://example.net", "https://example.net/", "HTTP://WWW.Example.NET/en/1?x#y", "x://net/", "x://anet/",
    "https://a.b.example.com/de/2", "https://example.com/DE/2", "https://example.org/fr/", "https://org/fr/x", "https://org?fr/", "https://a.org#f",
    "https://user@example.net:80/en/", "a://b://net/", "https://é.net/é?", "http://" + "a." * 3000 + "net/" + "p" * 5000, "http://.net/", "http://net./",
]


def plain(url, rules):
    host, path = urlfilter.split_url(url)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


def test_split():
    assert urlfilter.split_url("HtTp://Ab.C?d/e") == ("ab.c", "")
    assert urlfilter.split_url("x://Ab.C/d/E?f#g") == ("ab.c", "/d/E")
    assert urlfilter.split_url("no") == ("", "")


@pytest.mark.parametrize("shipped", [10, 0])
def test_judged_like_the_plain_loop(spark, shipped):
    pages = spark.createDataFrame([(i, u, "h", "k", 1) for i, u in enumerate(URLS)] + [(None, URLS[6], "h", "k", 1)], "page_id long, url string, html string, key string, host int")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    got = urlfilter.judge(pages, rules, max_shipped=shipped).collect()
    assert len(got) == len(URLS) + 1
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == plain(r["url"], URL_RULES)
    assert urlfilter.judge(pages.limit(0), URL_RULES).count() == 0


def test_found_strings_are_confirmed(tmp_path, monkeypatch):
    monkeypatch.setattr(xxhash, "xxh64_intdigest", lambda k: 7)  # every digest collides
    path = str(tmp_path / "rules.bin")
    urlfilter.write_rules([("a", "/", "block"), ("b", "/", "allow")], path)
    found = urlfilter.DigestArray(path)
    assert np.array_equal(found.find([b"b/", b"a/", b"c/"]) >= 0, [True, True, False])
    assert found.blocked[found.find([b"a/"])[0]] == 1


def test_no_rules(spark):
    pages = spark.createDataFrame([(1, "http://a/")], "page_id long, url string")
    assert urlfilter.judge(pages, []).first()["verdict"] == "allow"
