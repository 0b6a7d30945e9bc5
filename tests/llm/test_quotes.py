"""Quotation linking against the SQL counterpart and against hand-made conversations."""

import duckdb

from sievewatt.llm import oracle, quotes

ROWS = [
    (1, 0, "user", "The pump in hall two leaks again. Who can look at it today?"),
    (1, 1, "assistant", "I can be there at noon, with a new seal. The old one is worn."),
    (1, 2, "user", "Should we order more paper as well? It is nearly gone."),
    (1, 3, "assistant", "> I can be there at noon, with a\n> new seal.\nGood, the door will be open.\n"),
    (1, 4, "user", "On Monday the assistant wrote:\n>> The pump in hall two leaks again.\n> Good, the door will be open.\nThank you both."),
    (1, 5, None, "> Should we order more paper as well?\nYes, two boxes.\n> a line that nobody wrote here\n"),
    (2, 0, "user", "> Should we order more paper as well?\nA quote from another conversation."),
    (2, 1, "user", None),
    (3, 0, "user", ""),
    (3, 1, "user", "> > \n>"),
    (3, 1, "user", "the turn is there twice"),
    (4, None, "user", "no turn"),
    (None, 0, "user", "no conversation"),
    (5, 7, "user", "One sentence only here. Another sentence there."),
    (5, 9, "user", "> Another sentence there.\nOne sentence only here."),
    (5, 8, "user", "> One sentence only here.\n"),
    (6, 0, "user", "Yes."),
    (6, 1, "user", "Thanks"),
    (6, 2, "user", "> Thanks\nNo need."),
    (6, 3, "user", "> yes. \n>> no need.\nReally? Yes."),
    (6, 4, "user", "> Really?  Yes.\nWell, then."),
    (6, 5, "user", "> Really?\nonly a part of a message: no link"),
]
SCHEMA = "conv_id long, turn long, role string, text string, place string"


def run(spark, rows):
    df = spark.createDataFrame([(*r, "extra") for r in rows], SCHEMA)
    return df, quotes.conversations(df)


def test_links_order_and_text(spark):
    _, out = run(spark, ROWS)
    got = {(r["conv"], r["turn"]): r for r in out.collect() if r["conv"] == 1}
    assert {t: (r["parent"], r["root"]) for (_, t), r in got.items()} == {
        0: (None, 0), 1: (None, 1), 2: (None, 2), 3: (1, 1), 4: (3, 1), 5: (2, 2),
    }
    assert [t for (_, t), r in sorted(got.items(), key=lambda x: x[1]["place"])] == [0, 1, 3, 4, 2, 5]
    assert got[1, 4]["text"] == "Thank you both."
    assert got[1, 5]["formatted"] == "<|unknown|>\nYes, two boxes.\n"


def test_every_row_stays(spark):
    df, out = run(spark, ROWS)
    assert out.count() == len(ROWS)
    assert {r["parent"] for r in out.collect() if r["conv"] == 2} == {None}
    assert quotes.conversations(df.limit(0)).count() == 0


def test_short_quotes_are_looked_up_as_a_whole(spark):
    _, out = run(spark, ROWS)
    assert {r["turn"]: r["parent"] for r in out.collect() if r["conv"] == 6} == {0: None, 1: None, 2: 1, 3: 0, 4: 3, 5: None}


def test_places_of_long_threads(spark, monkeypatch):
    """Ranges of a few turns: a long thread, many threads, and turns or first turns that are missing."""
    monkeypatch.setattr(quotes, "RANGE", 3)
    rows = [(1, 0 if t % 5 else t, t) for t in range(40)] + [(2, t, t) for t in range(17)] + [(None, -7, -7), (None, -7, 2)]
    rows += [(3, None, None), (3, -4, -4), (3, 8, 9), (3, 8, 8)]
    got = quotes.places(spark.createDataFrame(rows, "conv long, root long, turn long")).collect()
    want = {}
    for conv in (1, 2, 3, None):
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: [(v is not None, v or 0) for v in r[1:]])
        want |= {(conv, r[2]): i for i, r in enumerate(mine)}
    assert len(got) == len(rows) and {(r["conv"], r["turn"]): r["place"] for r in got} == want


def test_same_as_sql(spark, tmp_path):
    rows = [r for r in ROWS if None not in r[:2]]
    df, out = run(spark, rows)
    con = duckdb.connect()
    df.toPandas().to_parquet(tmp_path / "c.parquet")
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/c.parquet'")
    mine = sorted((r["conv"], r["turn"], r["role"], r["parent"], r["root"], r["place"], r["text"]) for r in out.collect() if r["conv"] != 3)
    theirs = sorted(r[:7] for r in con.execute(oracle.OP8).fetchall() if r[0] != 3)
    assert [tuple(map(str, r)) for r in mine] == [tuple(map(str, r)) for r in theirs]
