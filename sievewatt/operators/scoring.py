"""From metrics to a 0-100 score per entity and day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievewatt.config import CheckSettings, Cols, ScoreSettings
from sievewatt.functions.columns import flag, score_category
from sievewatt.operators.checks import DAY, all_metrics
from sievewatt.operators.skew import outer_merge

COMPONENTS = ["completeness_score", "temporal_score", "business_score", "schema_score"]


def score(
    completeness: DataFrame,
    temporal: DataFrame,
    business: DataFrame,
    schema: DataFrame,
    entity: Sequence[str],
    cfg: ScoreSettings = ScoreSettings(),
) -> DataFrame:
    """Combine four separate metric tables; a component a table lacks counts as perfect."""
    keys = [*entity, DAY]
    parts = [
        completeness.select(*keys, (1 - F.col("missing_rate")).alias("completeness_score")),
        temporal.select(*keys, (1 - F.col("anomaly_rate")).alias("temporal_score")),
        business.select(*keys, (1 - F.col("violation_rate")).alias("business_score")),
        schema.select(*keys, F.col("schema_validity_score").alias("schema_score")),
    ]
    return _finish(outer_merge(parts, keys), keys, cfg)


def score_metrics(metrics: DataFrame, entity: Sequence[str], cfg: ScoreSettings = ScoreSettings()) -> DataFrame:
    """Score the table ``all_metrics`` returns."""
    keys = [*entity, DAY]
    parts = metrics.select(
        *keys,
        (1 - F.col("missing_rate")).alias("completeness_score"),
        (1 - F.col("anomaly_rate")).alias("temporal_score"),
        (1 - F.col("violation_rate")).alias("business_score"),
        F.col("schema_validity_score").alias("schema_score"),
    )
    return _finish(parts, keys, cfg)


def quality_scores(
    df: DataFrame,
    cols: Cols,
    checks: CheckSettings = CheckSettings(),
    cfg: ScoreSettings = ScoreSettings(),
    rows_per_slice: int | None = None,
    rows: DataFrame | None = None,
) -> DataFrame:
    return score_metrics(all_metrics(df, cols, checks, rows_per_slice, rows), cols.entity, cfg)


def _finish(parts: DataFrame, keys: Sequence[str], cfg: ScoreSettings) -> DataFrame:
    clamped = parts.select(*keys, *[_unit(F.coalesce(F.col(c), F.lit(1.0))).alias(c) for c in COMPONENTS])
    total = F.lit(0.0)
    for name, weight in cfg.weights.items():
        total = total + F.lit(weight) * F.col(name)
    return (
        clamped.withColumn("quality_score", total * 100.0)
        .withColumn("quality_category", score_category(F.col("quality_score")))
        .withColumn("is_low_quality", flag(F.col("quality_score") < cfg.low_quality_threshold))
    )


def _unit(c: Column) -> Column:
    return F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0))


def rollup(scores: DataFrame, by: Sequence[str] = (), grain: str = "day") -> DataFrame:
    """Average the scores over entities, per group and time window."""
    window = F.to_date(F.date_trunc(grain, F.col(DAY))).alias(f"{grain}_window")
    return (
        scores.groupBy(*by, window)
        .agg(
            F.avg("quality_score").alias("avg_quality_score"),
            F.count(F.lit(1)).alias("household_count"),
            F.sum("is_low_quality").alias("low_quality_count"),
            F.avg("completeness_score").alias("avg_completeness"),
            F.avg("temporal_score").alias("avg_temporal"),
            F.avg("business_score").alias("avg_business"),
            F.avg("schema_score").alias("avg_schema"),
        )
        .withColumn("low_quality_rate", F.col("low_quality_count") / F.col("household_count"))
    )


def summary(scores: DataFrame) -> DataFrame:
    """One row: average, lowest, highest score and the number of low-quality days."""
    return scores.agg(
        F.coalesce(F.avg("quality_score"), F.lit(0.0)).alias("avg_quality_score"),
        F.coalesce(F.min("quality_score"), F.lit(0.0)).alias("min_quality_score"),
        F.coalesce(F.max("quality_score"), F.lit(0.0)).alias("max_quality_score"),
        F.coalesce(F.sum("is_low_quality"), F.lit(0)).cast("long").alias("low_quality_count"),
    )
