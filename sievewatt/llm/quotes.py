"""Chat formatting with quotation linking, with DataFrame functions only.

Each line of a message has a quote level (the ``>`` signs before it). Level 0 is the message's own text; what
stands at a deeper level was said by others. Own and quoted text are cut into passages (sentences of the
lines of one level, joined, so that re-wrapped lines do no harm), passages are normalised and hashed, and a
quoted passage is joined to the first message of its conversation that says it in its own text. The
message that most passages of level 1 (else of the least level that is linked) come from is the one replied to;
of equally many the latest. Links always lead to earlier turns.

A message's thread starts at the message without a link that its links lead to. Reply order is the order of the
threads' first turns, then of the turns: answers stand behind what they answer. The text is the message's own,
without quotes and lines such as "On Monday X wrote:".

Hot conversations: originals are reduced to one row per conversation and passage before the join, and places are
numbered over distinct (thread, turn) pairs in ranges of :data:`RANGE` first turns, and within one first turn of
:data:`RANGE` turns, so no task gets a conversation or a long thread whole.

Defined results: a null text is empty, a null role is ``unknown``; a null turn is before all others and has no link;
null conversations are one conversation; rows that repeat a turn share its place; passages shorter than
:data:`SHORTEST` characters are too common to tell, but a quoted block, or a message, that has no longer one ("Yes. Thanks!") is
looked up as a whole; without quotes every message is its own thread; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievewatt.llm.common import durable

SHORTEST = 8
RANGE = 1024
QUOTE = r"^\s*>[> ]*"
WROTE = r"^\s*(On|Am|Le|El)\b.*(wrote|schrieb|écrit|escribió)[^:]*:\s*$"


def _lines(text: Column) -> Column:
    """(level, words) of each line."""
    return F.transform(
        F.split(F.coalesce(text, F.lit("")), "\n"),
        lambda x: F.struct(
            F.length(F.regexp_replace(F.regexp_extract(x, QUOTE, 0), "[^>]", "")).alias("level"),
            F.regexp_replace(x, QUOTE, "").alias("words"),
        ),
    )


def own_text(lines: Column) -> Column:
    own = F.filter(lines, lambda x: (x["level"] == 0) & ~x["words"].rlike(WROTE))
    return F.regexp_replace(F.array_join(F.transform(own, lambda x: x["words"]), "\n"), r"^\s+|\s+$", "")


def passages(text: Column) -> Column:
    """Normalised sentences of a text, without those too short to tell; the whole, marked as such, if all are."""
    flat = F.lower(F.regexp_replace(text, r"\s+", " "))
    cut = F.split(F.regexp_replace(flat, r"([.!?]) ", "$1\n"), "\n")
    long = F.array_distinct(F.filter(F.transform(cut, F.trim), lambda s: F.length(s) >= SHORTEST))
    # no sentence holds a line break, so a whole never equals one
    whole = F.array(F.concat(F.lit("\n"), F.trim(flat)))
    return F.when(F.size(long) > 0, long).when(F.length(F.trim(flat)) > 0, whole).otherwise(F.array().cast("array<string>"))


def parsed(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, lines, own) of every message."""
    rows = messages.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("unknown")).alias("role"),
        _lines(F.col(text)).alias("lines"),
    )
    return rows.withColumn("own", own_text(F.col("lines")))


def links(rows: DataFrame) -> DataFrame:
    """(conv, turn, parent): the earlier turn that a turn replies to, by what it quotes. ``rows`` as of :func:`parsed`."""
    quoting = rows.filter(F.exists("lines", lambda x: x["level"] > 0) & F.col("turn").isNotNull())
    level = F.explode(F.array_distinct(F.transform(F.filter("lines", lambda x: x["level"] > 0), lambda x: x["level"]))).alias("level")
    flow = F.array_join(F.transform(F.filter("lines", lambda x: x["level"] == F.col("level")), lambda x: x["words"]), " ")
    quoted = (
        quoting.select("conv", "turn", "lines", level)
        .select("conv", "turn", "level", F.explode(passages(flow)).alias("passage"))
        .select("conv", "turn", "level", F.xxhash64("passage").alias("h"), "passage")
        .distinct()
    )
    convs = quoting.select("conv").distinct()
    talked = rows.alias("r").join(convs.alias("c"), F.expr("r.conv <=> c.conv"), "left_semi")
    said = (
        talked.filter("turn IS NOT NULL")
        .select("conv", "turn", F.explode(passages(F.col("own"))).alias("passage"))
        .groupBy("conv", F.xxhash64("passage").alias("h"), "passage")
        .agg(F.min("turn").alias("origin"))
    )
    met = quoted.alias("q").join(
        said.alias("s"), F.expr("q.conv <=> s.conv AND q.h = s.h AND q.passage = s.passage AND s.origin < q.turn")
    )
    votes = met.groupBy("q.conv", "q.turn", "q.level", "s.origin").agg(F.count(F.lit(1)).alias("n"))
    best = F.max(F.struct((-F.col("level")).alias("near"), "n", "origin"))
    return votes.groupBy("conv", "turn").agg(best.alias("b")).select("conv", "turn", F.col("b.origin").alias("parent"))


def roots(parents: DataFrame) -> DataFrame:
    """(conv, turn, parent, root): the first message of the chain of links that each linked turn is in."""
    state = durable(parents.select("conv", "turn", "parent", F.col("parent").alias("root")))
    while True:
        ahead = state.select(F.col("conv").alias("c"), F.col("turn").alias("t"), F.col("root").alias("next"))
        state = durable(
            state.join(ahead, F.expr("conv <=> c AND root = t"), "left")
            .select("conv", "turn", "parent", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        )
        if state.filter("moved").isEmpty():
            return state.drop("moved")
        state = state.drop("moved")


def places(turns: DataFrame) -> DataFrame:
    """(conv, turn, place): numbers from 0 in the order of (root, turn), for distinct turns.

    Counted at three levels, each in the order of the one above: ranges of roots in a conversation, ranges of turns of the
    roots in such a range, turns in such a range.
    """
    ranged = turns.withColumns({"upper": F.floor(F.col("root") / RANGE), "lower": F.floor(F.col("turn") / RANGE)})

    def before(keys: list[str], order: list[str]) -> Column:
        """Rows of the groups that come earlier."""
        ahead = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in order])
        return F.coalesce(F.sum("n").over(ahead.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    sizes = durable(ranged.groupBy("conv", "upper", "root", "lower").agg(F.count(F.lit(1)).alias("n")))
    firsts = sizes.groupBy("conv", "upper").agg(F.sum("n").alias("n")).select("conv", "upper", before(["conv"], ["upper"]).alias("first"))
    within = sizes.select("conv", "upper", "root", "lower", before(["conv", "upper"], ["root", "lower"]).alias("within"))
    starts = within.alias("w").join(firsts.alias("f"), F.expr("w.conv <=> f.conv AND w.upper <=> f.upper"))
    starts = starts.select("w.conv", "w.root", "w.lower", (F.col("first") + F.col("within")).alias("start"))
    own = Window.partitionBy("conv", "root", "lower").orderBy(F.col("turn").asc_nulls_first())
    numbered = ranged.withColumn("number", F.row_number().over(own) - 1).alias("r")
    return numbered.join(starts.alias("s"), F.expr("r.conv <=> s.conv AND r.root <=> s.root AND r.lower <=> s.lower")).select(
        "r.conv", "r.turn", (F.col("start") + F.col("number")).cast("long").alias("place")
    )


def conversations(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, parent, root, place, text, formatted) for every message, in reply order by ``place``."""
    rows = parsed(messages, conv, turn, role, text)
    chained = roots(links(rows))
    turns = rows.groupBy("conv", "turn").agg(F.lit(1)).select("conv", "turn")
    rooted = turns.alias("t").join(chained.alias("c"), F.expr("t.conv <=> c.conv AND t.turn = c.turn"), "left").select(
        "t.conv", "t.turn", "c.parent", F.coalesce("c.root", "t.turn").alias("root")
    )
    placed = durable(rooted)
    told = placed.alias("a").join(places(placed).alias("b"), F.expr("a.conv <=> b.conv AND a.turn <=> b.turn")).select("a.*", "b.place")
    return (
        rows.alias("m")
        .join(durable(told).alias("p"), F.expr("m.conv <=> p.conv AND m.turn <=> p.turn"))
        .select(
            "m.conv", "m.turn", "m.role", "p.parent", "p.root", "p.place", F.col("m.own").alias("text"),
            F.concat(F.lit("<|"), F.col("m.role"), F.lit("|>\n"), F.col("m.own"), F.lit("\n")).alias("formatted"),
        )
    )
