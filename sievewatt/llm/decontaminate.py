"""Benchmark decontamination with DataFrame functions only.

The hashes of all n-grams (windows of ``n`` words) of the benchmark items are broadcast as a hash set. Documents
are cut into words, every window of a document is hashed and looked up as the scan passes it, and only numbers
leave the scan. Documents with a hit are then read again: the words of each window that hit are compared with the
item's, so that equal hashes of different words count for nothing. An item with fewer words, but not none, is one
window of its own length. The words of verified windows are hit.

The hash set's size is counted; beyond :data:`MOST_WINDOWS` it is shuffled.

Defined results: null, empty and wordless texts have no words and no hits; items without words have no
window; items with a null id mark words but are not listed; repeated items are one item; repeated documents
give a row each; without items nothing is hit; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievewatt.llm.common import ascii_lower, durable, small_side

N = 10
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Windows of the benchmark whose hashes are broadcast (16 bytes each).
MOST_WINDOWS = 1_000_000


def words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def _hash(w: str, start: Column, k: int) -> Column:
    return F.xxhash64(F.lit(k), *[F.get(w, start + j) for j in range(k)])


def _windows(w: str, k: int, make) -> Column:
    """``make(start)`` for every window of ``k`` words in the array ``w``."""
    blank = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(w) - k))
    return F.when(F.size(w) >= k, F.transform(blank, make))


def _hasher(k: int):
    return lambda i: _hash("w", i, k)


def benchmark(items: DataFrame, text_col: str = "text", id_col: str = "item_id", n: int = N) -> DataFrame:
    """(item_id, k, gram): the distinct windows of every item, their words joined by one space."""
    split = items.select(F.col(id_col).alias("item_id"), words(F.col(text_col)).alias("w")).filter(F.size("w") > 0)
    split = split.withColumn("k", F.least(F.lit(n), F.size("w")))
    starts = F.sequence(F.lit(0), F.size("w") - F.col("k"))
    grams = F.transform(starts, lambda i: F.array_join(F.slice("w", i + 1, F.col("k")), " "))
    return split.select("item_id", "k", F.explode(grams).alias("gram")).distinct()


def scan(docs: DataFrame, grams: DataFrame, lengths: list[int]) -> DataFrame:
    """(id, text_hash, n_words, k, start) of every window of ``docs`` (id, text_hash, text) whose hash some gram has;
    and a row with null ``k`` for each document."""
    hashed = None
    for k in lengths:  # 1 to n different lengths, as a rule one
        own = grams.filter(F.col("k") == k).select(F.split("gram", " ").alias("g")).select(_hash("g", F.lit(0), k).alias("h"))
        hashed = own if hashed is None else hashed.unionByName(own)
    marker = docs.sparkSession.range(1).select(F.lit(0).cast("long").alias("h"))
    known = durable(marker if hashed is None else hashed.unionByName(marker).distinct())
    cut = docs.select("id", "text_hash", words(F.col("text")).alias("w"))
    nothing = F.array().cast("array<bigint>")
    every = [F.coalesce(_windows("w", k, _hasher(k)), nothing) for k in lengths]
    # the last number is the document's own row
    numbers = cut.select(
        "id", "text_hash", F.size("w").cast("long").alias("n_words"), F.concat(*every, F.array(F.lit(0).cast("long"))).alias("hs")
    )
    passed = numbers.select("id", "text_hash", "n_words", F.posexplode_outer("hs").alias("at", "h"))
    met = passed.join(small_side(known, MOST_WINDOWS), "h")
    which, start, before = F.lit(None).cast("int"), F.lit(None).cast("int"), F.lit(0).cast("long")
    for k in reversed(lengths):
        before = F.lit(0).cast("long")
        for longer in lengths[: lengths.index(k)]:
            before = before + F.greatest(F.lit(0), F.col("n_words") - longer + 1)
        here = (F.col("at") >= before) & (F.col("at") < before + F.greatest(F.lit(0), F.col("n_words") - k + 1))
        which, start = F.when(here, F.lit(k)).otherwise(which), F.when(here, F.col("at") - before).otherwise(start)
    return durable(met.select("id", "text_hash", "n_words", which.alias("k"), start.cast("int").alias("start")))


def verified(docs: DataFrame, met: DataFrame, grams: DataFrame) -> DataFrame:
    """(id, text_hash, first, last, item_id) of the windows in ``met`` whose words are those of a gram."""
    starts = met.filter("k IS NOT NULL").groupBy("id", "text_hash").agg(F.collect_set(F.struct("k", "start")).alias("starts"))
    starts = durable(starts)
    same = F.expr("d.id <=> s.id AND d.text_hash = s.text_hash")
    # only keys are broadcast; what is found in a document goes to it in a shuffle of the documents with a hit
    keys = small_side(starts.select("id", "text_hash"))
    hit_docs = docs.alias("d").join(keys.alias("s"), same, "left_semi").dropDuplicates(["id", "text_hash"])
    texts = hit_docs.alias("d").join(starts.alias("s"), same).select("d.id", "d.text_hash", words(F.col("d.text")).alias("w"), "starts")
    found = F.transform("starts", lambda s: F.struct(s["k"].alias("k"), s["start"].alias("start"), F.array_join(F.slice("w", s["start"] + 1, s["k"]), " ").alias("gram")))
    hit = texts.select("id", "text_hash", F.explode(found).alias("x")).select("id", "text_hash", "x.*").distinct()
    return hit.join(small_side(grams), ["k", "gram"]).select(
        "id", "text_hash", F.col("start").alias("first"), (F.col("start") + F.col("k") - 1).alias("last"), "item_id"
    )


def _covered(spans: Column) -> Column:
    """Words in the union of (first, last) spans, which may overlap."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).alias("upto"))
    step = lambda acc, s: F.struct(
        (acc["n"] + F.greatest(F.lit(0), s["last"] - F.greatest(acc["upto"], s["first"] - 1)).cast("long")).alias("n"),
        F.greatest(acc["upto"], s["last"]).alias("upto"),
    )
    return F.aggregate(F.array_sort(spans), start, step)["n"]


def hits(
    docs: DataFrame, items: DataFrame, text_col: str = "text", id_col: str = "doc_id",
    item_text: str = "text", item_id: str = "item_id", n: int = N,
) -> DataFrame:
    """(id, text_hash, n_words, n_hit, items, spans) for every row of ``docs``; ``items`` are the ids of the items
    with a window in the text, ``spans`` the runs of hit words as (first, last) word numbers."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    grams = durable(benchmark(items, item_text, item_id, n))
    lengths = sorted((r[0] for r in grams.select("k").distinct().collect()), reverse=True)
    met = scan(keyed, grams, lengths)
    spans = verified(keyed, met, grams).groupBy("id", "text_hash").agg(
        F.collect_set(F.struct("first", "last")).alias("spans"), F.collect_set("item_id").alias("items")
    )
    return met.filter("k IS NULL").alias("d").join(spans.alias("s"), F.expr("d.id <=> s.id AND d.text_hash = s.text_hash"), "left").select(
        "d.id", "d.text_hash", "d.n_words",
        F.coalesce(_covered(F.col("s.spans")), F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("s.items", F.array().cast(spans.schema["items"].dataType)).alias("items"),
        F.coalesce("s.spans", F.array().cast(spans.schema["spans"].dataType)).alias("spans"),
    )


def remove_documents(
    docs: DataFrame, items: DataFrame, text_col: str = "text", id_col: str = "doc_id", most_hit: float = 0.0, **names
) -> DataFrame:
    """``docs`` without those whose share of hit words is above ``most_hit``; all columns stay."""
    marked = hits(docs, items, text_col, id_col, **names)
    bad = durable(marked.filter(F.col("n_hit") > F.lit(most_hit) * F.col("n_words")).select("id", "text_hash").distinct())
    return docs.alias("d").join(
        small_side(bad).alias("b"),
        (F.col(f"d.{id_col}").eqNullSafe(F.col("b.id"))) & (F.xxhash64(F.coalesce(F.col(f"d.{text_col}"), F.lit(""))) == F.col("b.text_hash")),
        "left_anti",
    )


def remove_spans(docs: DataFrame, items: DataFrame, text_col: str = "text", id_col: str = "doc_id", **names) -> DataFrame:
    """``docs`` with every hit word, and what stands between hit words of one run, cut out of the text."""
    marked = hits(docs, items, text_col, id_col, **names).filter("n_hit > 0").dropDuplicates(["id", "text_hash"])
    text = F.col(f"d.{text_col}")
    joined = docs.alias("d").join(
        marked.select("id", "text_hash", "spans").alias("m"),
        (F.col(f"d.{id_col}").eqNullSafe(F.col("m.id"))) & (F.xxhash64(F.coalesce(text, F.lit(""))) == F.col("m.text_hash")),
        "left",
    )
    # words and what stands before each, by the same pattern; positions agree with the numbers of the words
    upper_too = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    gaps = F.split(text, upper_too, -1)
    own = F.regexp_extract_all(text, F.lit(upper_too), F.lit(0))
    hit = lambda i: F.exists(F.col("m.spans"), lambda s: (s["first"] <= i) & (i <= s["last"]))
    inner = lambda i: F.exists(F.col("m.spans"), lambda s: (s["first"] < i) & (i <= s["last"]))
    pieces = F.transform(own, lambda w, i: F.concat(F.when(inner(i), "").otherwise(F.get(gaps, i)), F.when(hit(i), "").otherwise(w)))
    cut = F.concat(F.array_join(pieces, ""), F.element_at(gaps, -1))
    kept = [F.col(f"d.{c}") if c != text_col else F.when(F.col("m.id").isNull() & F.col("m.spans").isNull(), text).otherwise(cut).alias(c) for c in docs.columns]
    return joined.select(*kept)
