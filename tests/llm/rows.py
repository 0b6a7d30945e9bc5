"""Small documents with every awkward case, and columns whose names clash with those used inside."""

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, id long, row string, size long, "
    "key string, text_hash string, w string, spans string, score string, k string, shard string, bundle string"
)
CLASH = (-1, "r", -2, "k", "h", "w", "s", "x", "k", "9", "b")

LONG = " ".join(f"word{i % 997} of{i}" for i in range(30_000))
BASE = "the quick brown fox jumps over the lazy dog and runs far away from all the noise of the town at night"
NEAR = BASE.replace("night", "dawn")


def documents(spark, rows):
    """``rows``: (doc_id, text) or (doc_id, text, source)."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s1", 7, *CLASH) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


ODD = [
    (1, BASE, "a"),
    (2, NEAR, "a"),
    (3, BASE, None),
    (3, BASE, None),
    (4, None, "b"),
    (5, "", "b"),
    (6, " \t\n ", "c"),
    (7, LONG, "c"),
    (8, "one two three", "c"),
    (9, "ONE  two\tthree", "Z"),
    (10, "four words are here", ""),
    (None, BASE + " too", "a"),
    (None, None, None),
]
