"""The standing reports. Each takes DataFrames and returns one; top lists break ties by id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievewatt.functions.columns import day
from sievewatt.operators.checks import DAY
from sievewatt.operators.quantiles import quantiles
from sievewatt.operators.skew import lookup_join

SEVERITIES = ["critical", "warning"]


def recent(c: str, days: int, as_of: Column | None = None) -> Column:
    """Within the last ``days`` days of ``as_of`` (default: today)."""
    return F.col(c) >= (F.current_date() if as_of is None else as_of) - F.expr(f"INTERVAL {int(days)} DAYS")


def worst_group_days(
    scores: DataFrame, dim: DataFrame, on: Sequence[str], group: str, as_of: Column | None = None, days: int = 7, limit: int = 20
) -> DataFrame:
    """Lowest average score per group and day over the last days."""
    recent_scores = scores.filter(recent(DAY, days, as_of))
    joined = lookup_join(recent_scores, dim.select(*on, group), on)
    return (
        joined.groupBy(group, F.col(DAY).alias("day"))
        .agg(F.avg("quality_score").alias("avg_score"), F.count(F.lit(1)).alias("household_count"))
        .orderBy("avg_score", "day", group)
        .limit(limit)
    )


def incidents_by_day(incidents: DataFrame, as_of: Column | None = None, days: int = 30) -> DataFrame:
    """Incidents by day, rule and severity, newest day first."""
    return (
        incidents.filter(recent("incident_timestamp", days, as_of))
        .groupBy(day("incident_timestamp").alias("day"), "rule_name", "severity")
        .agg(F.count(F.lit(1)).alias("incident_count"), F.count_distinct("entity_id").alias("affected_households"))
        .orderBy(F.desc("day"), F.desc("incident_count"), "rule_name", "severity")
    )


def incidents_by_rule(incidents: DataFrame) -> DataFrame:
    return (
        incidents.groupBy("rule_name", "severity")
        .agg(F.count(F.lit(1)).alias("incident_count"), F.count_distinct("entity_id").alias("affected_entities"))
        .orderBy(F.desc("incident_count"), "rule_name", "severity")
    )


def severity_pivot(incidents: DataFrame) -> DataFrame:
    """One row per rule, one column per severity."""
    return incidents.groupBy("rule_name").pivot("severity", SEVERITIES).agg(F.count(F.lit(1))).fillna(0)


def incident_timeline(incidents: DataFrame) -> DataFrame:
    return (
        incidents.groupBy(day("incident_timestamp").alias("day")).agg(F.count(F.lit(1)).alias("daily_incidents")).orderBy("day")
    )


def predictions_for(predictions: DataFrame, on_day: Column | None = None, limit: int = 100) -> DataFrame:
    """Highest risks of one day (default: tomorrow)."""
    wanted = F.date_add(F.current_date(), 1) if on_day is None else on_day
    return predictions.filter(F.col("prediction_date") == wanted).orderBy(F.desc("risk_score"), "entity_id").limit(limit)


def high_risk(
    predictions: DataFrame, dim: DataFrame, on: Sequence[str], group: str, cut: float = 0.7, limit: int = 50
) -> DataFrame:
    """The riskiest entities with their group; the group is looked up after the list is cut."""
    top = predictions.filter(F.col("risk_score") >= cut).orderBy(F.desc("risk_score"), *on).limit(limit)
    return top.join(dim.select(*on, group), list(on), "left").orderBy(F.desc("risk_score"), *on)


def top_areas(area_totals: DataFrame, limit: int = 50) -> DataFrame:
    return area_totals.orderBy(F.desc("building_count"), "admin_area_id").limit(limit)


def worst_entities(scores: DataFrame, entity: Sequence[str], limit: int = 10) -> DataFrame:
    return (
        scores.groupBy(*entity)
        .agg(F.avg("quality_score").alias("avg_quality_score"), F.count(F.lit(1)).alias("days_with_data"))
        .orderBy("avg_quality_score", *entity)
        .limit(limit)
    )


def most_low_days(
    scores: DataFrame, dim: DataFrame, entity: Sequence[str], attributes: Sequence[str], threshold: float = 70.0, limit: int = 20
) -> DataFrame:
    """Entities with the most low-quality days.

    Counted and cut to the list first; attributes, one row per entity, are looked up for the list only.
    """
    top = (
        scores.filter(F.col("quality_score") < threshold)
        .groupBy(*entity)
        .agg(
            F.avg("quality_score").alias("avg_quality_score"),
            F.min("quality_score").alias("min_quality_score"),
            F.count(F.lit(1)).alias("low_quality_days"),
        )
        .orderBy(F.desc("low_quality_days"), "avg_quality_score", *entity)
        .limit(limit)
    )
    found = top.join(dim.select(*entity, *attributes), list(entity), "left")
    return found.orderBy(F.desc("low_quality_days"), "avg_quality_score", *entity)


def low_days_by_group(top_list: DataFrame, group: str) -> DataFrame:
    return top_list.groupBy(group).agg(
        F.sum("low_quality_days").alias("total_low_quality_days"), F.count(F.lit(1)).alias("household_count")
    )


def histogram(df: DataFrame, value: str, low: float, high: float, bins: int = 50) -> DataFrame:
    """(bin, bin_start, rows) over equal-width bins; the last bin includes its upper end."""
    width = (high - low) / bins
    b = F.least(F.floor((F.col(value) - low) / width), F.lit(bins - 1)).cast("int")
    return (
        df.filter(F.col(value).between(low, high))
        .groupBy(b.alias("bin"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .select("bin", (F.lit(low) + F.col("bin") * width).alias("bin_start"), "rows")
    )


def shares(df: DataFrame, category: str) -> DataFrame:
    """Rows and share per category."""
    counts = df.groupBy(category).agg(F.count(F.lit(1)).alias("rows"))
    # As many rows as categories; the total is one more.
    total = counts.agg(F.sum("rows").alias("_all"))
    joined = counts.withColumn("_k", F.lit(1)).join(F.broadcast(total.withColumn("_k", F.lit(1))), "_k")
    return joined.select(category, "rows", (F.col("rows") / F.col("_all")).alias("share"))


def statistics(df: DataFrame, value: str, low: float | None = None, step: float = 0.05) -> DataFrame:
    """One row: mean, median, deviation, extremes, count and (with ``low``) the share below it."""
    plain = df.agg(
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.count(F.lit(1)).alias("total"),
        *([F.count_if(F.col(value) < low).alias("low_count")] if low is not None else []),
    )
    if low is not None:
        plain = plain.withColumn("low_share", F.col("low_count") / F.col("total"))
    middle = quantiles(df, value, [0.5], step).select(F.col("value").alias("median"), F.lit(1).alias("_k"))
    return plain.withColumn("_k", F.lit(1)).join(F.broadcast(middle), "_k", "left").drop("_k")


def daily_trend(scores: DataFrame) -> DataFrame:
    return (
        scores.groupBy(F.col(DAY).alias("day"))
        .agg(
            F.avg("quality_score").alias("avg_quality_score"),
            F.min("quality_score").alias("min_quality_score"),
            F.max("quality_score").alias("max_quality_score"),
            F.count(F.lit(1)).alias("household_days"),
        )
        .orderBy("day")
    )


def scores_by_group(scores: DataFrame, dim: DataFrame, on: Sequence[str], group: str, threshold: float = 70.0) -> DataFrame:
    joined = lookup_join(scores, dim.select(*on, group), on)
    return (
        joined.groupBy(group)
        .agg(
            F.avg("quality_score").alias("avg_quality_score"),
            F.min("quality_score").alias("min_quality_score"),
            F.max("quality_score").alias("max_quality_score"),
            F.count(F.lit(1)).alias("total_records"),
            F.count_if(F.col("quality_score") < threshold).alias("low_quality_count"),
        )
        .withColumn("low_quality_rate", F.col("low_quality_count") / F.col("total_records"))
        .orderBy("avg_quality_score", group)
    )


def component_breakdown(scores: DataFrame, weights: dict[str, float]) -> DataFrame:
    """(component, mean, weight, contribution), one row per component."""
    means = scores.agg(*[F.avg(c).alias(c) for c in weights])
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("component"), F.col(c).alias("mean"), F.lit(w).alias("weight"), (F.col(c) * w * 100).alias("contribution"))
            for c, w in weights.items()
        ]
    )
    return means.select(F.explode(rows).alias("r")).select("r.*")


def latest_run(runs: DataFrame) -> DataFrame:
    """Row counts of the newest run, one row per table."""
    newest = runs.orderBy(F.desc("run_timestamp"), "pipeline_name").limit(1)
    return newest.select("pipeline_name", "status", F.explode("row_counts").alias("table", "rows"))


def score_dates(scores: DataFrame) -> DataFrame:
    """The distinct days that have scores, in order."""
    return scores.select(DAY).filter(F.col(DAY).isNotNull()).distinct().orderBy(DAY)
