"""Exact quantiles and exact splits without sorting everything in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


# Rows of one bucket of a split, and the number of different hashes that the buckets are ranges of.
ROWS_PER_BUCKET = 50_000
HASHES = 1 << 48


def quantiles(df: DataFrame, value: str, probs: Sequence[float], step: float = 0.05) -> DataFrame:
    """(prob, value): quantiles with linear interpolation between neighbouring ranks.

    Values are counted per distinct value, then per bucket of width ``step``. Only the buckets that
    hold a wanted rank are looked at value by value, so no task ever sees more than one bucket. The
    running count goes over the buckets alone; choose ``step`` so that range / step stays small.
    """
    values = (
        df.filter(F.col(value).isNotNull())
        .groupBy(F.col(value).cast("double").alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_b", F.floor(F.col("_v") / step))
    )
    upto = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rank = F.col("prob") * (F.col("_total") - 1)
    spots = (
        values.groupBy("_b")
        .agg(F.sum("_n").alias("_bn"))
        .withColumn("_before", F.coalesce(F.sum("_bn").over(upto), F.lit(0)))
        .withColumn("_total", F.sum("_bn").over(everything))
        .withColumn("prob", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
        .withColumn("_rank", rank)
        .withColumn("_at", F.explode(F.array_distinct(F.array(F.floor("_rank"), F.ceil("_rank")))))
        .filter((F.col("_at") >= F.col("_before")) & (F.col("_at") < F.col("_before") + F.col("_bn")))
    )
    inside = Window.partitionBy("prob", "_at").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    # `spots` has at most two rows per probability.
    picked = (
        values.join(F.broadcast(spots.select("prob", "_rank", "_at", "_b", "_before")), "_b")
        .withColumn("_first", F.col("_before") + F.coalesce(F.sum("_n").over(inside), F.lit(0)))
        .filter((F.col("_at") >= F.col("_first")) & (F.col("_at") < F.col("_first") + F.col("_n")))
    )
    part = F.max("_rank") - F.floor(F.max("_rank"))
    return picked.groupBy("prob").agg((F.min("_v") + part * (F.max("_v") - F.min("_v"))).alias("value"))


def median(df: DataFrame, value: str) -> float | None:
    row = quantiles(df, value, [0.5]).first()
    return None if row is None else float(row["value"])


def stratified_split(
    df: DataFrame,
    label: str,
    keys: Sequence[str],
    train_fraction: float = 0.8,
    seed: int = 42,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Add ``is_train``: exactly the wanted share of every class, the same on every run.

    Rows are ranked by a hash of their key. The rank is the number of rows in lower hash buckets plus
    the place within the bucket, so a class never has to be sorted as a whole. Buckets are ranges of the
    hash; their number follows the number of rows and does not change the ranks. A class with fewer
    than two rows is put in training.
    """
    buckets = df.count() // rows_per_bucket + 1
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))
    spot = F.conv(F.substring(digest, 1, 12), 16, 10).cast("long")
    rows = df.withColumn("_h", spot).withColumn("_b", F.floor(F.col("_h") / F.lit(float(HASHES)) * buckets).cast("int"))
    # At most classes x buckets rows.
    sizes = rows.groupBy(label, "_b").agg(F.count(F.lit(1)).alias("_bn"))
    by_label = Window.partitionBy(label)
    before = by_label.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        label,
        "_b",
        F.coalesce(F.sum("_bn").over(before), F.lit(0)).alias("_before"),
        F.sum("_bn").over(by_label).alias("_class"),
    )
    place = F.row_number().over(Window.partitionBy(label, "_b").orderBy("_h", *keys))
    keep = F.when(F.col("_class") < 2, F.col("_class")).otherwise(F.floor(F.col("_class") * F.lit(train_fraction) + 1e-9))
    return (
        rows.withColumn("_place", place)
        .join(F.broadcast(starts), [label, "_b"])
        .withColumn("is_train", (F.col("_before") + F.col("_place") <= keep).cast("int"))
        .drop("_h", "_b", "_place", "_before", "_class")
    )
