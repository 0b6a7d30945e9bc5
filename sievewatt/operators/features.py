"""Features and labels for predicting a bad day, at the grain of entity and day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievewatt.config import Cols, RiskSettings
from sievewatt.functions.columns import day, day_number, entity_id, flag, number
from sievewatt.operators.checks import DAY
from sievewatt.operators.quantiles import median
from sievewatt.operators.skew import lookup_join, outer_merge

KEYS = ["entity_id", DAY]

INCIDENT_COUNTS = [
    "total_incidents",
    "completeness_incidents",
    "temporal_incidents",
    "business_incidents",
    "schema_incidents",
    "critical_incidents",
    "warning_incidents",
]

# Same-day results, from which the target is computed; never features.
SAME_DAY = ["completeness_score", "temporal_score", "business_score", "schema_score", "missing_rate"]
LEAKY_WORDS = ["quality_score", "future_quality", "target"]


def keyed_scores(scores: DataFrame, entity: Sequence[str]) -> DataFrame:
    """Scores with the entity as one string, without rows that belong to no day."""
    return scores.filter(F.col(DAY).isNotNull()).select(
        entity_id(list(entity)).alias("entity_id"), *[c for c in scores.columns if c not in entity]
    )


def incident_counts(incidents: DataFrame) -> DataFrame:
    """Incidents per entity and day: all, by family, by severity."""
    named = [
        F.count_if(F.col("rule_name").contains(k)).alias(f"{k}_incidents")
        for k in ("completeness", "temporal", "business", "schema")
    ]
    graded = [F.count_if(F.col("severity") == s).alias(f"{s}_incidents") for s in ("critical", "warning")]
    timed = incidents.filter(F.col("incident_timestamp").isNotNull())
    return timed.groupBy("entity_id", day("incident_timestamp").alias(DAY)).agg(
        F.count(F.lit(1)).alias("total_incidents"), *named, *graded
    )


def consumption_stats(readings: DataFrame, cols: Cols) -> DataFrame:
    """Readings per entity and day: count, spread, weather if the readings carry it."""
    v = number(cols.value)
    aggs = [
        F.count(F.lit(1)).alias("reading_count"),
        F.avg(v).alias("avg_consumption"),
        F.stddev_samp(v).alias("std_consumption"),
        F.min(v).alias("min_consumption"),
        F.max(v).alias("max_consumption"),
    ]
    if "temperature_celsius" in readings.columns:
        t = F.col("temperature_celsius")
        aggs += [F.avg(t).alias("avg_temperature"), F.min(t).alias("min_temperature"), F.max(t).alias("max_temperature")]
    if "humidity_ratio" in readings.columns:
        aggs.append(F.avg("humidity_ratio").alias("avg_humidity"))
    timed = readings.filter(F.col(cols.ts).isNotNull())
    cv = F.when(F.col("avg_consumption") > 0, F.col("std_consumption") / F.col("avg_consumption")).otherwise(0.0)
    # by the entity's own columns, by which clean readings are dealt already; the text is made of the result
    daily = timed.groupBy(*cols.entity, day(cols.ts).alias(DAY)).agg(*aggs)
    facts = [c for c in daily.columns if c not in (*cols.entity, DAY)]
    return daily.select(entity_id(cols.entity).alias("entity_id"), DAY, *facts).withColumns(
        {"consumption_cv": cv, "day_of_week": F.dayofweek(DAY), "month": F.month(DAY)}
    )


def features(
    scores: DataFrame,
    incidents: DataFrame,
    readings: DataFrame,
    cols: Cols,
    dims: DataFrame | None = None,
    holidays: DataFrame | None = None,
    windows: Sequence[int] = (7, 30),
    exclude_current: bool = False,
) -> DataFrame:
    """Same-day facts plus trailing averages and sums over calendar days.

    ``windows`` count days, not rows, so a silent day does not stretch them. Component scores enter
    only as trailing averages. ``dims`` adds entity attributes, ``holidays`` a flag per day.
    """
    parts = keyed_scores(scores, cols.entity).select(
        *KEYS,
        (1 - F.col("completeness_score")).alias("missing_rate"),
        *[F.col(f"{c}_score").alias(f"_{c}") for c in ("completeness", "temporal", "business", "schema")],
    )
    # dealt by entity, so that the windows below find their rows together
    merged = outer_merge([parts, incident_counts(incidents), consumption_stats(readings, cols)], KEYS, ["entity_id"])
    zero = {c: 0 for c in [*INCIDENT_COUNTS, "reading_count"]}
    zero.update({c: 0.0 for c in ("avg_consumption", "std_consumption", "consumption_cv", "missing_rate")})
    base = (
        merged.fillna(zero)
        .withColumns({"day_of_week": F.dayofweek(DAY), "month": F.month(DAY)})
        .withColumn("_day", day_number(DAY))
    )
    # One row per entity and day, so a partition holds at most the days of one entity.
    per_entity = Window.partitionBy("entity_id").orderBy("_day")
    rolled = {}
    for w in windows:
        frame = per_entity.rangeBetween(-w, -1) if exclude_current else per_entity.rangeBetween(-(w - 1), 0)
        mean = lambda c, f=frame: F.avg(c).over(f)
        total = lambda c, f=frame: F.sum(c).over(f)
        rolled[f"missing_rate_{w}d"] = mean("missing_rate")
        rolled[f"incident_count_{w}d"] = total("total_incidents")
        for c in ("completeness", "temporal", "business", "schema"):
            rolled[f"avg_{c}_score_{w}d"] = mean(f"_{c}")
        rolled[f"std_consumption_{w}d"] = mean("std_consumption")
        rolled[f"avg_consumption_{w}d"] = mean("avg_consumption")
        rolled[f"consumption_trend_{w}d"] = F.col("avg_consumption") - mean("avg_consumption")
        for c in ("critical", "completeness", "temporal", "business"):
            rolled[f"{c}_incidents_{w}d"] = total(f"{c}_incidents")
        for c, how in (("avg_temperature", F.avg), ("min_temperature", F.min), ("max_temperature", F.max), ("avg_humidity", F.avg)):
            if c in base.columns:
                rolled[f"{c}_{w}d"] = how(c).over(frame)
    out = base.withColumns(rolled).drop("_day", "_completeness", "_temporal", "_business", "_schema")
    if dims is not None:
        out = lookup_join(out, _keyed_dims(dims, cols), ["entity_id"])
    if holidays is not None:
        out = holiday_flag(out, holidays)
    return out


def _keyed_dims(dims: DataFrame, cols: Cols) -> DataFrame:
    return dims.select(entity_id(cols.entity).alias("entity_id"), *[c for c in dims.columns if c not in cols.entity])


def holiday_flag(df: DataFrame, holidays: DataFrame, date_col: str = "holiday_date") -> DataFrame:
    """``is_holiday``: 1 on the listed days."""
    listed = holidays.select(F.col(date_col).alias(DAY)).filter(F.col(DAY).isNotNull()).distinct()
    marked = lookup_join(df, listed.withColumn("is_holiday", F.lit(1)), [DAY])
    return marked.fillna({"is_holiday": 0})


def labels(
    scores: DataFrame,
    incidents: DataFrame,
    entity: Sequence[str],
    cfg: RiskSettings = RiskSettings(),
    auto_median: bool = False,
    any_incident: bool = False,
    check: bool = True,
) -> DataFrame:
    """(entity_id, score_date, future_quality_score, future_incident_count, target).

    The target is 1 if ``horizon_days`` later the score is below the threshold or there are many
    incidents. ``auto_median`` replaces the threshold by the median score, ``any_incident`` lets a
    single incident decide. With ``check`` at least two different days are required.
    """
    keyed = keyed_scores(scores, entity)
    if check and keyed.select(DAY).distinct().limit(2).count() < 2:
        raise ValueError("labels need scores of at least two different days")
    threshold = median(keyed, "quality_score") if auto_median else cfg.low_quality_threshold
    back = F.date_sub(F.col(DAY), cfg.horizon_days).alias(DAY)
    future = keyed.select("entity_id", back, F.col("quality_score").alias("future_quality_score"))
    counts = incident_counts(incidents).select(
        "entity_id", back, F.col("total_incidents").alias("future_incident_count")
    )
    # Scores and incidents are unique per entity and day, so one union and one grouping replace two joins.
    here = keyed.select(*KEYS, F.lit(True).alias("_here"))
    known = (
        outer_merge([here, future, counts], KEYS)
        .filter("_here AND future_quality_score IS NOT NULL")
        .drop("_here")
        .fillna({"future_incident_count": 0})
    )
    risky = (F.col("future_quality_score") < threshold) | (
        F.col("future_incident_count") >= (1 if any_incident else cfg.high_incident_threshold)
    )
    return known.withColumn("target", flag(risky))


def training_set(feature_rows: DataFrame, label_rows: DataFrame, check: bool = True) -> DataFrame:
    """Feature rows that have a label. Nothing about the future except the target is kept."""
    joined = feature_rows.join(label_rows.select(*KEYS, "target"), KEYS)
    if check and joined.isEmpty():
        raise ValueError("no feature row has a label; check that their dates overlap")
    return joined


def feature_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Numeric columns a model may see: neither keys nor anything the target is computed from."""
    kinds = ("int", "bigint", "double", "float", "smallint", "tinyint")
    barred = {*KEYS, *exclude, *SAME_DAY}
    return [
        f.name
        for f in df.schema.fields
        if f.dataType.simpleString() in kinds
        and f.name not in barred
        and not any(w in f.name.lower() for w in LEAKY_WORDS)
    ]
