"""Keeping one hot key from landing in one task.

Three tools, each exact:

* ``lookup_join`` - a join to a side with one row per key. Broadcast when that side is small;
  otherwise a shuffled join in which only the hot keys are salted.
* ``find_slices`` / ``with_slice`` - cut the ordered history of a hot entity into consecutive
  slices, so that windows run per (entity, slice). What a window needs from earlier slices is
  carried over by the functions in ``ordered.py``.
* ``outer_merge`` - line up several per-key tables with one shuffle.

Detecting hot keys costs a column-pruned scan with a partial aggregate. It is skipped for inputs
that would fit in a single task anyway.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievewatt.functions.columns import micros
from sievewatt.runtime import BROADCAST_BYTES, SINGLE_TASK_BYTES, durable, fits_broadcast, plan_bytes, row_bytes

# Rows of one key that a single task is allowed to hold before the key counts as hot.
HOT_ROWS = 4_000_000

# Salts for rows whose join key is null: they match nothing but must not share one task.
NULL_SALTS = 64


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """(keys..., _salts) for keys above ``hot_rows``; at most rows / hot_rows of them."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_rows)
    return durable(counts.select(*keys, F.ceil(F.col("_n") / hot_rows).cast("int").alias("_salts")))


def lookup_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    how: str = "left",
    *,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
    small_is_summary_of_big: bool = False,
) -> DataFrame:
    """Join ``big`` to ``small``, which has at most one row per ``on`` key.

    ``small_is_summary_of_big`` says that ``small`` was aggregated from ``big`` and so cannot be
    larger; its own estimate would only repeat the size of ``big``.
    """
    on = list(on)
    if fits_broadcast(small, broadcast_bytes) or (
        small_is_summary_of_big and fits_broadcast(big, broadcast_bytes)
    ):
        return big.join(F.broadcast(small), on, how)
    if small_is_summary_of_big:
        # The estimate is useless here, so write the summary down once and measure it.
        small = durable(small)
        if small.count() * row_bytes(small.schema) <= broadcast_bytes:
            return big.join(F.broadcast(small), on, how)
    return salted_join(big, small, on, how, hot_rows=hot_rows)


def salted_join(
    big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "left", *, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Shuffled join that spreads hot keys of ``big`` over several tasks.

    The salt is the input partition's number, which stays the same when a task is retried. Only hot
    keys are repeated on the small side.
    """
    on = list(on)
    hot = F.broadcast(hot_keys(big.select(*on).dropna(), on, hot_rows))
    has_null = F.lit(False)
    for key in on:
        has_null = has_null | F.col(key).isNull()
    spread = F.spark_partition_id()
    left = (
        big.join(hot, on, "left")
        .withColumn(
            "_salt",
            F.when(has_null, F.pmod(spread, F.lit(NULL_SALTS)))
            .when(F.col("_salts").isNotNull(), F.pmod(spread, F.col("_salts")))
            .otherwise(F.lit(0)),
        )
        .drop("_salts")
    )
    right = (
        small.join(hot, on, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)))
        .drop("_salts")
    )
    return left.join(right, on + ["_salt"], how).drop("_salt")


@dataclass(frozen=True)
class Slices:
    """How hot entities are cut along ``order``; ``table`` is None when nothing is hot."""

    entity: tuple[str, ...]
    order: str
    table: DataFrame | None = None

    @property
    def keys(self) -> list[str]:
        """What windows are partitioned by; without slices the entity alone, so that rows already dealt by it stay."""
        return list(self.entity) + ([] if self.table is None else ["_slice"])


# How much finer than the ideal equal-width slice to go when an entity's rows bunch up.
_REFINEMENTS = (1, 4, 16, 64, 256, 4096, 65536)


def find_slices(
    df: DataFrame, entity: Sequence[str], order: str, rows_per_slice: int | None = None
) -> Slices:
    """Measure which entities are hot and how wide their slices along ``order`` must be.

    For each hot entity the widest of a few candidate widths is taken whose fullest slice has few
    enough distinct positions (the windows run on rows that are unique per position). The result has at most rows / rows_per_slice rows, so it is safe to broadcast.
    Passing ``rows_per_slice`` forces the measurement on small inputs.
    """
    entity = tuple(entity)
    if rows_per_slice is None:
        if plan_bytes(df) <= SINGLE_TASK_BYTES:
            return Slices(entity, order)
        rows_per_slice = HOT_ROWS
    pos = order_number(df, order)
    points = df.select(*entity, pos.alias("_pos")).filter(F.col("_pos").isNotNull())
    hot = (
        points.groupBy(*entity)
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_lo"), F.max("_pos").alias("_hi"))
        .filter(F.col("_n") > rows_per_slice)
    )
    hot = durable(
        hot.select(
            *entity,
            "_lo",
            F.greatest(
                F.lit(1.0), (F.col("_hi") - F.col("_lo") + 1) / F.ceil(F.col("_n") / rows_per_slice)
            ).alias("_width"),
        )
    )
    if hot.isEmpty():
        return Slices(entity, order)
    finer = F.explode(F.array(*[F.lit(float(r)) for r in _REFINEMENTS]))
    tried = (
        join_null_safe(points, hot, entity, "inner", small=True)
        .withColumn("_finer", finer)
        .withColumn("_width", F.greatest(F.lit(1.0), F.col("_width") / F.col("_finer")))
        .groupBy(*entity, "_lo", "_width", F.floor((F.col("_pos") - F.col("_lo")) / F.col("_width")).alias("_s"))
        .agg(F.approx_count_distinct("_pos").alias("_distinct"))
        .groupBy(*entity, "_lo", "_width")
        .agg(F.max("_distinct").alias("_fullest"))
    )
    chosen = tried.groupBy(*entity, "_lo").agg(
        F.coalesce(
            F.max(F.when(F.col("_fullest") <= rows_per_slice, F.col("_width"))), F.min("_width")
        ).alias("_width")
    )
    return Slices(entity, order, durable(chosen))


def in_one_place(df: DataFrame, entity: Sequence[str], hot_rows: int | None = None, parts: int | None = None) -> DataFrame | None:
    """``df`` dealt by entity, if no entity has more rows, copies included, than one task may hold; else None.

    What follows per entity (copies, windows, days) then needs no other shuffle. ``parts`` fixes the number of tasks.
    """
    fits = hot_rows is None and plan_bytes(df) <= SINGLE_TASK_BYTES
    if fits or hot_keys(df.select(*entity), entity, hot_rows or HOT_ROWS).isEmpty():
        return df.repartition(*entity) if parts is None else df.repartition(parts, *entity)
    return None


def with_slice(df: DataFrame, slices: Slices) -> DataFrame:
    """Add ``_slice``: 0 for ordinary entities, the slice's number for hot ones."""
    if slices.table is None:
        return df.withColumn("_slice", F.lit(0).cast("long"))
    at = F.floor((order_number(df, slices.order) - F.col("_lo")) / F.col("_width"))
    return (
        join_null_safe(df, slices.table, slices.entity, "left", small=True)
        .withColumn("_slice", F.coalesce(at, F.lit(0)).cast("long"))
        .drop("_lo", "_width")
    )


def join_null_safe(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, small: bool = False
) -> DataFrame:
    """Equi join in which a missing key matches a missing key. ``small`` broadcasts the right side."""
    renamed = right.select(
        *[F.col(k).alias(f"_right_{k}") for k in keys], *[c for c in right.columns if c not in keys]
    )
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    joined = left.join(F.broadcast(renamed) if small else renamed, same, how)
    return joined.drop(*[f"_right_{k}" for k in keys])


def order_number(df: DataFrame, order: str) -> Column:
    """The ordering column as a whole number, so that slices can be cut by arithmetic."""
    dtype = df.schema[order].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return micros(order)
    return F.col(order).cast("long")


def outer_merge(frames: Sequence[DataFrame], keys: Sequence[str], dealt_by: Sequence[str] = ()) -> DataFrame:
    """Full outer join of tables that are unique on ``keys`` and share no other column.

    Written as a union and one grouping: a single shuffle however many tables there are, and null
    keys line up with null keys. ``dealt_by`` names the keys to shuffle by if a window over them follows.
    """
    keys = list(keys)
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame, allowMissingColumns=True)
    rest = [c for c in merged.columns if c not in keys]
    if dealt_by:
        merged = merged.repartition(*dealt_by)
    return merged.groupBy(*keys).agg(*[F.max(c).alias(c) for c in rest])
