"""Silver-layer cleaning: duplicates, ranges, gaps in values, calendar columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievewatt.config import Cols
from sievewatt.functions.columns import calendar_parts, micros, number
from sievewatt.operators.ordered import last_known, trailing_mean
from sievewatt.operators.skew import Slices, find_slices, in_one_place, join_null_safe

# Fixed value: how many earlier half-hours the trailing mean looks at (one day).
TRAILING_ROWS = 48


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the smallest by ``order``, then by the remaining columns.

    An aggregate rather than ``row_number``: copies of one key are reduced before the shuffle, so a
    key with very many copies never gathers in one task, and the survivor is always the same row.
    """
    keys = list(keys)
    rest = list(order) + [c for c in df.columns if c not in keys and c not in order]
    if not rest:
        return df.distinct()
    kept = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_kept"))
    return kept.select(*keys, *[F.col("_kept")[c].alias(c) for c in rest]).select(*df.columns)


def in_range(value: str | Column, low: float, high: float) -> Column:
    """True for values inside the range and for missing ones, which are imputed later."""
    v = number(value)
    return v.isNull() | v.between(low, high)


def range_filter(df: DataFrame, value: str, low: float, high: float) -> DataFrame:
    return df.filter(in_range(value, low, high))


def impute_trailing_mean(
    df: DataFrame, cols: Cols, rows: int = TRAILING_ROWS, rows_per_slice: int | None = None, slices: Slices | None = None
) -> DataFrame:
    """Replace missing values by the mean of the entity's last ``rows`` + 1 readings."""
    slices = slices or find_slices(df, cols.entity, cols.ts, rows_per_slice)
    known = number(cols.value)
    out = trailing_mean(df, known, "_mean", slices, rows, _tie_break(df, cols))
    return out.withColumn(cols.value, F.coalesce(known, F.col("_mean"))).drop("_mean")


def forward_fill(
    df: DataFrame,
    cols: Cols,
    max_age_minutes: float | None = None,
    rows_per_slice: int | None = None,
    slices: Slices | None = None,
) -> DataFrame:
    """Replace missing values by the entity's latest known one, if it is not older than the limit."""
    slices = slices or find_slices(df, cols.entity, cols.ts, rows_per_slice)
    known = number(cols.value)
    out = last_known(df, known, "_last", slices, tie_break=_tie_break(df, cols))
    filled = F.col("_last")["value"]
    if max_age_minutes is not None:
        age = micros(F.col(cols.ts)) - micros(F.col("_last")["at"])
        filled = F.when(age <= int(max_age_minutes * 60_000_000), filled)
    return out.withColumn(cols.value, F.coalesce(known, filled)).drop("_last")


def add_calendar(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumns(calendar_parts(ts))


def clean_readings(
    df: DataFrame,
    cols: Cols,
    low: float = 0.0,
    high: float = 50.0,
    impute: str = "trailing_mean",
    rows_per_slice: int | None = None,
) -> DataFrame:
    """The silver recipe: unique, in range, imputed, with calendar columns and a processed flag."""
    order = [cols.arrival] if cols.arrival and cols.arrival in df.columns else []
    # one shuffle for copies and for windows, unless an entity needs more than one task
    placed = in_one_place(df, cols.entity, rows_per_slice)
    slices = None if placed is None else Slices(tuple(cols.entity), cols.ts)
    unique = dedupe(df if placed is None else placed, [*cols.entity, cols.ts], order)
    kept = range_filter(unique, cols.value, low, high)
    if impute == "trailing_mean":
        filled = impute_trailing_mean(kept, cols, rows_per_slice=rows_per_slice, slices=slices)
    elif impute == "forward_fill":
        filled = forward_fill(kept, cols, rows_per_slice=rows_per_slice, slices=slices)
    else:
        raise ValueError(f"unknown imputation {impute!r}")
    return add_calendar(filled.filter(F.col(cols.value).isNotNull()), cols.ts).withColumn(
        "_silver_processed", F.coalesce(F.col(cols.value), F.lit(0.0)) > 0
    )


def rejected_readings(
    df: DataFrame,
    cols: Cols,
    low: float = 0.0,
    high: float = 50.0,
    rows_per_slice: int | None = None,
) -> DataFrame:
    """What the silver recipe drops, with the reason and how many identical rows it stands for.

    Reasons: ``duplicate``, ``below_min``, ``above_max``, ``not_imputable``. Summing ``row_count``
    over the result and counting the cleaned rows gives the number of input rows.
    """
    keys = [*cols.entity, cols.ts]
    order = [cols.arrival] if cols.arrival and cols.arrival in df.columns else []
    rest = order + [c for c in df.columns if c not in keys and c not in order]
    # One shuffle for all groupings and windows, as in clean_readings. One task makes all that comes of its rows, so that Spark,
    # which counts the rows once for each use, would merge too many tasks.
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = in_one_place(df, cols.entity, rows_per_slice, parts)
    slices = None if placed is None else Slices(tuple(cols.entity), cols.ts)
    copies = (df if placed is None else placed).groupBy(*df.columns).agg(F.count(F.lit(1)).alias("row_count"))
    # Survivor per key, carried with its copies; every other content of the key is a duplicate.
    kept = copies.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_kept"))
    v = number(F.col("_kept")[cols.value])
    survivors = kept.select(*keys, *[F.col("_kept")[c].alias(c) for c in rest], v.alias("_v"))
    out_of_range = survivors.withColumn(
        "reject_reason", F.when(F.col("_v") < low, "below_min").when(F.col("_v") > high, "above_max")
    ).filter(F.col("reject_reason").isNotNull())
    # Copies of the survivor are duplicates too, so its content contributes one row fewer.
    minus_survivor = kept.select(*keys, *[F.col("_kept")[c].alias(c) for c in rest], F.lit(-1).cast("long").alias("row_count"))
    duplicates = (
        copies.select(*keys, *rest, "row_count")
        .unionByName(minus_survivor)
        .groupBy(*keys, *rest)
        .agg(F.sum("row_count").alias("row_count"))
        .filter(F.col("row_count") > 0)
        .withColumn("reject_reason", F.lit("duplicate"))
    )
    usable = survivors.drop("_v").filter(in_range(cols.value, low, high))
    blank = impute_trailing_mean(usable, cols, rows_per_slice=rows_per_slice, slices=slices).filter(F.col(cols.value).isNull())
    columns = [*df.columns, "reject_reason", "row_count"]
    one = F.lit(1).cast("long")
    return (
        duplicates.select(*columns)
        .unionByName(out_of_range.withColumn("row_count", one).select(*columns))
        .unionByName(blank.withColumns({"reject_reason": F.lit("not_imputable"), "row_count": one}).select(*columns))
    )


def split_rejected(
    df: DataFrame, cols: Cols, low: float = 0.0, high: float = 50.0, rows_per_slice: int | None = None
) -> tuple[DataFrame, DataFrame]:
    return (
        clean_readings(df, cols, low, high, rows_per_slice=rows_per_slice),
        rejected_readings(df, cols, low, high, rows_per_slice),
    )


def missing_from(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of one layer whose key never reached the next one."""
    return join_null_safe(before, after.select(*keys), keys, "left_anti")


def standardise(df: DataFrame, upper: Sequence[str] = (), trimmed: Sequence[str] = ()) -> DataFrame:
    """Trim category columns, and upper-case those in ``upper``."""
    changes = {c: F.upper(F.trim(F.col(c))) for c in upper}
    changes.update({c: F.trim(F.col(c)) for c in trimmed})
    return df.withColumns(changes)


def _tie_break(df: DataFrame, cols: Cols) -> list[str]:
    return [cols.arrival] if cols.arrival and cols.arrival in df.columns and cols.arrival != cols.ts else []
