"""Mix sources to target weights: repetition rates per source, whole copies plus one hash-seeded draw.

Sizes are summed per source, each source gets a target and the rate ``target / source size``, and a document
is emitted ``floor(rate)`` times plus once more with a probability of the rate's fraction. The draw is a
number in [0, 1) from a digest of the document's id, so it does not depend on partitions, order or retries.
Rows that share an id are numbered by source and text, and each but the first draws with its number as well. A
digest holds several such numbers; per source, the one whose draws come nearest to the target is used for all its
documents.

Defined results: a null text has size 0; a null source is a source of its own, after the others; a null id
is a value like any other; repeated rows draw each for itself, so that the same rows in another order give the same
rows with the same numbers of copies; a source without words
has target 0 and its documents are taken once or not at all, which adds nothing; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievewatt.llm.common import durable, numbered, small_side

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0
# Numbers of 32 bits that two SHA-256 digests of an id hold.
DRAWS = 16
# Rows of one id that one task numbers at a time.
ROWS_PER_RUN = 20_000


def _draw(key: Column, j: int) -> Column:
    digest = F.sha2(F.concat(key, F.lit(f":{j // 8}")), 256)
    return F.conv(F.substring(digest, 8 * (j % 8) + 1, 8), 16, 10).cast("long") / F.lit(2.0**32)


def targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """(source, source_size, target, rate) from (source, size).

    All targets together are ``share`` times all sizes, in proportion to the weights, which are dealt to the
    sources in order; no target is above ``most`` times its source's size. What a capped source leaves goes to
    the others by weight until none is above: the caps that hold are those of the smallest size per weight,
    so one pass over the sources in that order finds the level at which all others end.
    The window holds one row per source, not per document.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    listed = F.array(*[F.lit(w) for w in weights])
    weighted = per_source.withColumn("n", F.row_number().over(by_name)).withColumn(
        "weight", F.element_at(listed, ((F.col("n") - 1) % len(weights) + 1).cast("int"))
    )
    by_ratio = Window.orderBy(F.col("source_size") / F.col("weight"), "n")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    wanted = F.lit(share) * F.col("all_size")
    capped = F.lit(most) * F.coalesce(F.col("size_before"), F.lit(0))
    left = F.col("all_weight") - F.coalesce(F.col("weight_before"), F.lit(0))
    levels = (
        weighted.withColumn("all_size", F.sum("source_size").over(everything))
        .withColumn("all_weight", F.sum("weight").over(everything))
        .withColumn("size_before", F.sum("source_size").over(before))
        .withColumn("weight_before", F.sum("weight").over(before))
        .withColumn("level", (wanted - capped) / left)
        # the first source in this order that its cap does not hold sets the level of all that follow
        .withColumn("level", F.when(F.lit(most) * F.col("source_size") >= F.col("level") * F.col("weight"), F.col("level")))
        .withColumn("level", F.first("level", ignorenulls=True).over(by_ratio.rowsBetween(Window.unboundedPreceding, 0)))
    )
    cap = F.lit(most) * F.col("source_size")
    target = F.when(F.col("level").isNull(), cap).otherwise(F.least(cap, F.col("level") * F.col("weight")))
    return levels.select("source", "source_size", target.alias("target")).withColumn(
        "rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    )


def plan_copies(
    sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """(source, source_size, target, whole, fraction, seed): how every source's documents are repeated.

    ``sized`` has (draw, source, size) and is read twice. ``seed`` is the draw of :data:`DRAWS` to use.
    """
    rates = durable(targets(sized, weights, share, most))
    rates = (
        rates.withColumn("whole", F.floor("rate").cast("long")).withColumn("fraction", F.col("rate") - F.col("whole"))
    )
    key = F.col("d.draw")
    joined = sized.alias("d").join(small_side(rates).alias("r"), F.expr("d.source <=> r.source"))
    sums = joined.groupBy("r.source").agg(
        *[
            F.sum(F.when(_draw(key, j) < F.col("fraction"), F.col("d.size")).otherwise(0)).alias(f"s{j}")
            for j in range(DRAWS)
        ]
    )
    off = [F.struct(F.abs(F.col(f"s{j}") - F.col("fraction") * F.col("source_size")).alias("off"), F.lit(j).alias("seed")) for j in range(DRAWS)]
    return (
        rates.alias("r")
        .join(sums.alias("s"), F.expr("r.source <=> s.source"))
        .select("r.*", F.array_min(F.array(*off))["seed"].alias("seed"))
    )


def copies(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """``sized`` with source_size, target and the number of ``copies`` of each row."""
    key = F.col("d.draw")
    drawn = F.element_at(F.array(*[_draw(key, j) for j in range(DRAWS)]), F.col("p.seed") + 1)
    return sized.alias("d").join(small_side(plan).alias("p"), F.expr("d.source <=> p.source")).select(
        *[f"d.{c}" for c in sized.columns if c != "draw"], "p.source_size", "p.target", (F.col("p.whole") + (drawn < F.col("p.fraction")).cast("long")).alias("copies")
    )


def drawing(rows: DataFrame, rows_per_run: int = ROWS_PER_RUN) -> DataFrame:
    """``rows`` (id, source, text_hash and others) with the name that each draws by in ``draw`` instead of ``text_hash``.

    Only rows whose id repeats are shuffled. ``rows`` is read several times and has to be a checkpointed table.
    """
    name = F.coalesce(F.col("id").cast("string"), F.lit("null"))
    named = rows.withColumn("draw", name)
    again = durable(named.groupBy("draw").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("draw").alias("shared")))
    if again.isEmpty():
        return named.drop("text_hash")
    side = small_side(again)
    once = named.join(side, F.col("draw") == F.col("shared"), "left_anti")
    repeated = durable(named.join(side, F.col("draw") == F.col("shared"), "left_semi"))
    numbers = numbered(repeated, "draw", ["source", "text_hash"], "nth", rows_per_run)
    nth = F.when(F.col("nth") > 0, F.concat(F.lit("#"), F.col("nth").cast("string"))).otherwise("")
    return once.unionByName(numbers.withColumn("draw", F.concat("draw", nth)).drop("nth")).drop("text_hash")


def sizes_of(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """(id, source, size, text_hash): words per document."""
    return docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(text_col).alias("text_hash"),
    )


def mix(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", source_col: str = "source", **rules) -> DataFrame:
    """(id, source, size, source_size, target, copies) for every row of ``docs``. Texts are read once."""
    sized = drawing(durable(sizes_of(docs, text_col, id_col, source_col)))
    return copies(sized, durable(plan_copies(sized, **rules)))


def mixed(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", source_col: str = "source", **rules) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with their own columns."""
    plan = durable(plan_copies(drawing(durable(sizes_of(docs, text_col, id_col, source_col))), **rules))
    marked = docs.select(
        F.struct("*").alias("row"),
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        F.xxhash64(text_col).alias("text_hash"),
    )
    taken = copies(drawing(marked), plan)
    repeated = taken.filter("copies > 0").select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))))
    return repeated.select("row.*")
