"""Shards of near-equal bytes: longest-processing-time scheduling of groups that must stay together.

Groups are sorted by size, largest first, and each goes to the shard with the least load, kept in a heap.
Every distinct text is a group, so there are as many groups as documents; only the ones that matter for
balance are scheduled one by one. A group above ``total / (shards * GRAIN)`` is an item of its own (there can
be no more than ``shards * GRAIN`` of those); all smaller groups are dealt by hash into a fixed number of
bundles, which are items too. The driver schedules that bounded list; rows find their shard by hash, or by a
broadcast of the large groups.

Defined results: a null text has no bytes and all null texts are one group; an empty text is a text like any
other; equal rows have one slot each; fewer groups than shards leave shards empty; no rows give no rows.
A group larger than a shard's share stays whole, and its shard is then above the others.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievewatt.llm.common import durable, numbered

SHARDS = 40
# Items per shard: groups over 1/GRAIN of a shard's share are scheduled singly.
GRAIN = 64
BUNDLES_PER_SHARD = 128
OVERHEAD = 16
# Rows that one task numbers at a time.
ROWS_PER_RUN = 20_000


def schedule(sizes: list[tuple[str, int]], shards: int) -> dict[str, int]:
    """Shard of each (name, size) item: largest first, each to the least loaded shard."""
    heap = [(0, s) for s in range(shards)]
    out = {}
    for name, size in sorted(sizes, key=lambda x: (-x[1], x[0])):
        load, shard = heapq.heappop(heap)
        out[name] = shard
        heapq.heappush(heap, (load + size, shard))
    return out


def group_key(text: Column) -> Column:
    """128 bits that stand for a text; null texts share a name that no text has."""
    return F.coalesce(F.md5(F.encode(text, "utf-8")), F.lit("null"))


def _item(kind: str, name: Column) -> Column:
    """The name of a scheduled item: a single group and a bundle never share one."""
    return F.concat(F.lit(f"{kind}:"), name)


def assign(rows: DataFrame, shards: int = SHARDS, grain: int = GRAIN, bundles: int | None = None) -> DataFrame:
    """``rows`` (with ``group`` and ``size``) and the ``shard`` of each. ``rows`` is read three times."""
    spark = rows.sparkSession
    bundles = bundles or shards * BUNDLES_PER_SHARD
    groups = durable(rows.groupBy("group").agg(F.sum("size").alias("size")))
    total = groups.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    single, bundle = _item("group", F.col("group")), _item("bundle", F.pmod(F.xxhash64("group"), F.lit(bundles)).cast("string"))
    large = F.col("size") * (shards * grain) > F.lit(total)
    items = groups.groupBy(F.when(large, single).otherwise(bundle).alias("item")).agg(F.sum("size").alias("size"))
    # at most bundles + shards * grain rows, whatever the input
    placed = schedule([(r["item"], r["size"]) for r in items.collect()], shards)
    where = F.broadcast(spark.createDataFrame(list(placed.items()), "item string, shard int"))
    return (
        rows.withColumn("bundle", bundle)
        .withColumn("single", single)
        .join(where.select(F.col("item").alias("single"), F.col("shard").alias("own")), "single", "left")
        .join(where.withColumnRenamed("item", "bundle"), "bundle", "left")
        .withColumn("shard", F.coalesce("own", "shard"))
        .drop("bundle", "single", "own")
    )


def slots(rows: DataFrame, order: list[str], rows_per_run: int = ROWS_PER_RUN) -> DataFrame:
    """``slot``: a number per row, from 0 without gaps within each shard."""
    return numbered(rows, "shard", order, "slot", rows_per_run)


def shard(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", shards: int = SHARDS, **limits) -> DataFrame:
    """(id, size, text_crc32, shard, slot) for every row of ``docs``. Texts are read once."""
    text = F.col(text_col)
    rows = durable(
        docs.select(
            F.col(id_col).alias("id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
            F.crc32(F.encode(text, "utf-8")).alias("text_crc32"),
            group_key(text).alias("group"),
        )
    )
    placed = durable(assign(rows, shards, **limits))
    return slots(placed, ["id", "group"]).select("id", "size", "text_crc32", "shard", "slot")
