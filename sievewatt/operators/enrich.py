"""Joining readings to what is known about their entity and their hour, and the daily gold table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewatt.config import Cols
from sievewatt.functions.columns import number
from sievewatt.operators.clean import dedupe, standardise
from sievewatt.operators.skew import join_null_safe, lookup_join

# The weather columns that readings are enriched with.
WEATHER_COLUMNS = [
    "temperature_celsius",
    "apparent_temperature_celsius",
    "humidity_ratio",
    "pressure_mb",
    "wind_speed_ms",
    "weather_summary",
]


def enrich_entities(
    readings: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    attributes: Sequence[str],
    upper: Sequence[str] = (),
    **join_options,
) -> DataFrame:
    """Left join entity attributes, with categories trimmed and (for ``upper``) in capitals."""
    slim = dedupe(dim.select(*on, *attributes), on)
    tidy = standardise(slim, upper=upper, trimmed=[a for a in attributes if a not in upper])
    return lookup_join(readings, tidy, on, **join_options)


def enrich_hourly(
    readings: DataFrame,
    weather: DataFrame,
    ts: str,
    weather_ts: str = "timestamp",
    columns: Sequence[str] = WEATHER_COLUMNS,
    **join_options,
) -> DataFrame:
    """Left join the weather of the reading's hour; the earliest row counts if an hour has several."""
    columns = [c for c in columns if c in weather.columns]
    hour = F.date_trunc("hour", F.col(weather_ts).cast("timestamp"))
    hourly = dedupe(
        weather.select(hour.alias("_hour"), F.col(weather_ts).alias("_at"), *columns).filter(F.col("_hour").isNotNull()),
        ["_hour"],
        ["_at"],
    ).drop("_at")
    keyed = readings.withColumn("_hour", F.date_trunc("hour", F.col(ts).cast("timestamp")))
    return lookup_join(keyed, hourly, ["_hour"], **join_options).drop("_hour")


def join_enriched(household: DataFrame, weather: DataFrame, cols: Cols, columns: Sequence[str] = WEATHER_COLUMNS) -> DataFrame:
    """Put the two enriched tables side by side; both are unique on entity and time, a missing time included."""
    keys = [*cols.entity, cols.ts]
    extra = [c for c in columns if c in weather.columns and c not in household.columns]
    return join_null_safe(household, weather.select(*keys, *extra), keys, "left")


def consumption_analytics(
    df: DataFrame, cols: Cols, groups: Sequence[str] = ("acorn_group", "tariff_type")
) -> DataFrame:
    """Daily figures per entity, on readings that carry attributes, calendar columns and weather."""
    v = number(cols.value)
    keys = [*cols.entity, "date", *[g for g in groups if g in df.columns], "year", "month", "day_of_week"]
    aggs = [
        F.count(F.lit(1)).alias("halfhourly_readings_count"),
        F.avg(v).alias("avg_consumption_kwh"),
        F.sum(v).alias("total_daily_consumption_kwh"),
        F.min(v).alias("min_consumption_kwh"),
        F.max(v).alias("max_consumption_kwh"),
        F.stddev_samp(v).alias("std_consumption_kwh"),
    ]
    if "temperature_celsius" in df.columns:
        t = F.col("temperature_celsius")
        aggs += [
            F.avg(t).alias("avg_temperature_celsius"),
            F.min(t).alias("min_temperature_celsius"),
            F.max(t).alias("max_temperature_celsius"),
        ]
    if "humidity_ratio" in df.columns:
        aggs.append(F.avg("humidity_ratio").alias("avg_humidity_ratio"))
    per_reading = F.try_divide(F.col("total_daily_consumption_kwh"), F.col("halfhourly_readings_count"))
    return df.groupBy(*keys).agg(*aggs).withColumn("consumption_per_reading", per_reading)
