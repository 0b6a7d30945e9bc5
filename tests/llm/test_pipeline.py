"""The pipeline on a small folder of tables, stage by stage, and the registry."""

import random
import re
from collections import Counter

import corpus_pipeline
import pytest
from rows import BASE, documents
from test_mixing_sharding import plain_targets
from test_toxicity import corpus

import __spark_entry__ as entry
from sievewatt.llm import registry


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("sf"))
    rows, labels = corpus(600)
    rng = random.Random(8)
    sources = ["a", "a", "b", None]
    full = [(i, t, rng.choice(sources)) for i, t in rows]
    clean = [i for i, y, _ in labels if not y]
    texts = dict(rows)
    full += [(1000 + i, texts[c], "b") for i, c in enumerate(clean[:30])]  # exact copies
    full += [(2000 + i, texts[c] + " end", "a") for i, c in enumerate(clean[30:50])]  # near copies
    full += [(3000 + i, f"start {i} " + BASE, "a") for i in range(3)]  # benchmark passages
    full += [(4000, None, None), (4001, "", "a"), (4002, None, "b"), (None, "a text without an id " * 3, "c")]
    documents(spark, full).repartition(4).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int, quality int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, BASE), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, full, {i for i, y, _ in labels if y}


def test_every_stage(spark, sf):
    folder, full, toxic = sf
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
        docs = docs.cache()
        seen[name] = docs.collect()
    ids = {n: Counter(r["doc_id"] for r in rows) for n, rows in seen.items()}
    want = {r[0] for r in full} - toxic
    assert set(ids["toxicity"]) == want
    want -= set(range(1000, 1030)) | set(range(2000, 2020))
    want -= {3001, 3002}  # near copies of 3000
    assert set(ids["ngram_jaccard_join"]) == want and max(ids["ngram_jaccard_join"].values()) == 1
    assert set(ids["decontamination"]) == want - {3000}
    kept = seen["decontamination"]
    size = lambda t: len((t or "").split())
    sizes = Counter()
    for r in kept:
        sizes[r["source"]] += size(r["text"])
    taken = Counter()
    for r in seen["mixing"]:
        taken[r["source"]] += size(r["text"])
    for s, t in plain_targets(dict(sizes)).items():
        assert abs(taken[s] - t) <= 0.1 * t
    assert ids["sharding"] == ids["mixing"]
    assert Counter(r["shard"] for r in seen["sharding"]).keys() <= set(range(40))


def test_run_gives_the_last_stage(spark, sf):
    out = corpus_pipeline.run(spark, sf[0])
    assert out.columns == ["doc_id", "size", "text_crc32", "shard", "slot"] and out.count() > 0


def test_registered():
    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
    assert "pipeline" in entry.queries() and set(registry.ORACLE) <= set(registry.QUERIES)
