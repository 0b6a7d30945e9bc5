"""Helpers that several operators of this folder share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sievewatt.runtime import durable

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

__all__ = ["UPPER", "ascii_lower", "bounded_batches", "durable", "lean", "numbered", "slices_of", "small_side", "table"]

BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1000
SLICE_ROWS = 256

Batches = Iterator[pa.RecordBatch]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z lower-cased and every other character as it is.

    ``lower`` does that for pure ASCII and is fast there; it also changes letters beyond ASCII, so
    texts that hold any go through ``translate``.
    """
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def small_side(df: DataFrame, most: int = 500_000) -> DataFrame:
    """``df`` marked for broadcast if it has no more than ``most`` narrow rows, which is counted; else as it is, so
    that the join is shuffled. ``df`` is read twice and should be a checkpointed table."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def bounded_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Let no more than ``rows`` rows, whole texts, go to a Python worker at a time; a smaller setting stays."""
    if not 0 < int(spark.conf.get(BATCH_SETTING, "10000")) <= rows:
        spark.conf.set(BATCH_SETTING, str(rows))


@lru_cache(maxsize=1)
def _trim() -> Callable[[int], int] | None:
    try:
        return ctypes.CDLL("libc.so.6").malloc_trim
    except (OSError, AttributeError):
        return None


def lean(run: Callable[[Batches], Batches], rows: int = SLICE_ROWS) -> Callable[[Batches], Batches]:
    """``run`` with few rows at a time, so that what is made of them stays small, and with freed memory given back
    at the end: Spark keeps Python workers for later tasks, and what they hold then adds up."""

    def sliced(batches: Batches) -> Batches:
        for batch in batches:
            for begin in range(0, batch.num_rows, rows):
                yield batch.slice(begin, rows)

    def wrapped(batches: Batches) -> Batches:
        try:
            yield from run(sliced(batches))
        finally:
            pa.default_memory_pool().release_unused()
            if _trim():
                _trim()(0)

    return wrapped


def numbered(rows: DataFrame, part: str, order: list[str], name: str, rows_per_run: int) -> DataFrame:
    """``rows`` and a number for each, from 0 without gaps within each ``part`` (which holds no null).

    A part may hold any share of all rows, so it is numbered in runs of about ``rows_per_run`` rows: a run's first
    number is the count of the runs before it. Runs are ranges of a hash of ``order``; one that repeated rows make
    much larger is cut once more by the place of its rows in ``rows``, which is read three times and has to be
    a written or checkpointed table.
    """
    runs = rows.count() // rows_per_run + 1
    dealt = rows.withColumn("run", F.pmod(F.xxhash64(*[F.col(c) for c in order]), F.lit(runs)).cast("long"))
    dealt = dealt.withColumn("cut", F.lit(0).cast("long"))
    counts = dealt.groupBy(part, "run", "cut").agg(F.count(F.lit(1)).alias("n"))
    heavy = durable(counts.filter(F.col("n") > 4 * rows_per_run).select(F.col(part).alias("p"), F.col("run").alias("r"), "n"))
    if not heavy.isEmpty():
        # no more of these than rows / (4 * rows_per_run)
        cuts = F.coalesce(F.ceil(F.col("n") / rows_per_run), F.lit(1)).cast("long")
        place = F.xxhash64(F.monotonically_increasing_id())
        dealt = (
            dealt.withColumn("place", place)
            .join(small_side(heavy), (F.col(part) == F.col("p")) & (F.col("run") == F.col("r")), "left")
            .withColumn("cut", F.pmod("place", cuts))
            .drop("p", "r", "n", "place")
        )
        counts = dealt.groupBy(part, "run", "cut").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(part).orderBy("run", "cut").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(part, "run", "cut", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inner = F.row_number().over(Window.partitionBy(part, "run", "cut").orderBy(*order)) - 1
    return (
        dealt.withColumn("place", inner)
        .join(starts, [part, "run", "cut"])
        .withColumn(name, (F.col("start") + F.col("place")).cast("long"))
        .drop("run", "cut", "place", "start")
    )


def slices_of(texts: list[str | None], chars: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Index ranges over ``texts`` that hold about ``chars`` characters each, so that arrays made of one
    range stay small whatever the batch; a longer text is a range of its own."""
    begin = held = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if held and held + n > chars:
            yield begin, i
            begin, held = i, 0
        held += n
    if begin < len(texts):
        yield begin, len(texts)
