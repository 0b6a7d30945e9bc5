"""Windows along time that do not need a whole entity in one task.

Each function runs its window per (entity, slice). If some entities were sliced, one summary row per
slice is passed forward through a second window over slices, and joined back. The join keys are the
window's own partitioning, so the rows are not shuffled again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievewatt.operators.skew import Slices, join_null_safe, with_slice
from sievewatt.runtime import durable


def running_totals(df: DataFrame, order: Sequence[str | Column], totals: dict[str, str]) -> DataFrame:
    """``df`` and, for each column and name in ``totals``, the sum of the column over all rows before, in ``order``.

    The rows are sorted over all tasks and written once; each task then adds up its own range, and a range starts
    with the sums of the ones before it. Only rows that are equal in ``order`` share a range for certain.
    """
    sorted_rows = durable(df.orderBy(*order).withColumn("_range", F.spark_partition_id()))
    # one row per task
    per_range = sorted_rows.groupBy("_range").agg(*[F.sum(c).alias(f"_{c}") for c in totals])
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_range.select("_range", *[F.coalesce(F.sum(f"_{c}").over(earlier), F.lit(0)).alias(f"_{c}") for c in totals])
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = sorted_rows.withColumns({f"_{c}_in": F.coalesce(F.sum(c).over(inside), F.lit(0)) for c in totals})
    out = out.join(F.broadcast(starts), "_range").withColumns({name: F.col(f"_{c}") + F.col(f"_{c}_in") for c, name in totals.items()})
    return out.drop("_range", *[f"_{c}" for c in totals], *[f"_{c}_in" for c in totals])


def row_numbers(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``df`` and each row's number in ``order``, from 0 without gaps, the same however the rows are partitioned."""
    return running_totals(df.withColumn("_one", F.lit(1).cast("long")), order, {"_one": name}).drop("_one")


def previous_value(
    df: DataFrame,
    value: str,
    name: str,
    slices: Slices,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """``value`` of the entity's previous row in ``slices.order``; null for its first row."""
    order = [slices.order, *tie_break]
    rows = with_slice(df, slices)
    inside = Window.partitionBy(*slices.keys).orderBy(*order)
    out = rows.withColumn(name, F.lag(value).over(inside))
    if slices.table is None:
        return out.drop("_slice")
    out = out.withColumn("_row", F.row_number().over(inside))
    last = _hot_rows(df, slices).groupBy(*slices.keys).agg(
        F.max(F.struct(*order, F.col(value).alias("_carry")))["_carry"].alias("_last")
    )
    before = last.withColumn("_carried", F.lag("_last").over(_over_slices(slices))).drop("_last")
    return (
        join_null_safe(out, before, slices.keys, "left")
        .withColumn(name, F.when(F.col("_row") == 1, F.col("_carried")).otherwise(F.col(name)))
        .drop("_slice", "_row", "_carried")
    )


def trailing_mean(
    df: DataFrame, value: Column, name: str, slices: Slices, rows: int, tie_break: Sequence[str] = ()
) -> DataFrame:
    """Mean of the known values among this row and the ``rows`` before it."""
    order = [slices.order, *tie_break]
    data = with_slice(df.withColumn("_v", value), slices)
    inside = Window.partitionBy(*slices.keys).orderBy(*order)
    frame = inside.rowsBetween(-rows, 0)
    out = data.withColumn("_sum", F.sum("_v").over(frame)).withColumn("_cnt", F.count("_v").over(frame))
    if slices.table is None:
        return out.withColumn(name, F.col("_sum") / F.nullif(F.col("_cnt"), F.lit(0))).drop(
            "_v", "_sum", "_cnt", "_slice"
        )
    out = out.withColumn("_row", F.row_number().over(inside))
    # The last `rows` rows of each slice; earlier slices together give what a slice's head lacks.
    newest_first = Window.partitionBy(*slices.keys).orderBy(*[F.col(c).desc() for c in order])
    tails = (
        _hot_rows(df.withColumn("_v", value), slices)
        .withColumn("_back", F.row_number().over(newest_first))
        .filter(F.col("_back") <= rows)
        .groupBy(*slices.keys)
        .agg(F.array_sort(F.collect_list(F.struct((-F.col("_back")).alias("p"), F.col("_v").alias("v")))).alias("_t"))
        .withColumn("_t", F.transform("_t", lambda s: F.struct(s["v"].alias("v"))))
    )
    earlier = _over_slices(slices).rowsBetween(-rows, -1)
    carried = tails.withColumn("_before", F.flatten(F.collect_list("_t").over(earlier))).drop("_t")
    # A row `_row` places into its slice still lacks `rows + 1 - _row` rows from before it.
    lacking = F.greatest(F.lit(rows + 1) - F.col("_row"), F.lit(0))
    have = F.size("_before")
    take = F.least(lacking, have)
    head = F.when(take > 0, F.slice("_before", (have - take + 1).cast("int"), take.cast("int")))
    known = F.filter(F.coalesce(head, F.expr("cast(array() as array<struct<v:double>>)")), lambda s: s["v"].isNotNull())
    return (
        join_null_safe(out, carried, slices.keys, "left")
        .withColumn("_known", known)
        .withColumn("_cnt", F.col("_cnt") + F.size("_known"))
        .withColumn(
            "_sum",
            F.coalesce(F.col("_sum"), F.lit(0.0))
            + F.aggregate("_known", F.lit(0.0), lambda a, s: a + s["v"]),
        )
        .withColumn(name, F.col("_sum") / F.nullif(F.col("_cnt"), F.lit(0)))
        .drop("_v", "_sum", "_cnt", "_slice", "_row", "_before", "_known")
    )


def last_known(
    df: DataFrame, value: Column, name: str, slices: Slices, at: Column | None = None, tie_break: Sequence[str] = ()
) -> DataFrame:
    """The latest known value up to this row, as a struct (value, at)."""
    order = [slices.order, *tie_break]
    stamped = F.struct(value.alias("value"), (F.col(slices.order) if at is None else at).alias("at"))
    data = with_slice(df.withColumn("_p", F.when(value.isNotNull(), stamped)), slices)
    upto = Window.partitionBy(*slices.keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = data.withColumn(name, F.last("_p", ignorenulls=True).over(upto))
    if slices.table is None:
        return out.drop("_p", "_slice")
    known = _hot_rows(df.withColumn("_p", F.when(value.isNotNull(), stamped)), slices)
    ends = known.groupBy(*slices.keys).agg(
        F.max(F.when(F.col("_p").isNotNull(), F.struct(*order, "_p")))["_p"].alias("_end")
    )
    earlier = _over_slices(slices).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("_before", F.last("_end", ignorenulls=True).over(earlier)).drop("_end")
    return (
        join_null_safe(out, carried, slices.keys, "left")
        .withColumn(name, F.coalesce(F.col(name), F.col("_before")))
        .drop("_p", "_slice", "_before")
    )


def _hot_rows(df: DataFrame, slices: Slices) -> DataFrame:
    """Rows of sliced entities only; the others have no slice boundary to cross."""
    hot = slices.table.select(*slices.entity)
    return with_slice(join_null_safe(df, hot, slices.entity, "left_semi", small=True), slices)


def _over_slices(slices: Slices):
    return Window.partitionBy(*slices.entity).orderBy("_slice")
