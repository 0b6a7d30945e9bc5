"""How the provided tables stand in for the layers, in Spark.

``events`` are the readings (entity ``user_id``), ``customer`` the households. Events are clean, so a
dirty view adds faults to the whole table by rule: nothing is left out, some rows are repeated. The
same rules are written as SQL in ``oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewatt.config import CheckSettings, Cols, RiskSettings, ScoreSettings
from sievewatt.operators import checks, clean, enrich, features, scoring
from sievewatt.runtime import durable_together, scratch_path

COLS = Cols(("user_id",), "ts", "value", "arrival")

# Events come at about 2.5 a day and user at random moments, hence the wide tolerance.
CHECKS = CheckSettings(
    interval_minutes=480,
    tolerance_minutes=240,
    max_value=100.0,
    z_score=3.0,
    value_range=(0.0, 400.0),
    enums={"event_type": ["view", "click", "signup", "purchase", "error"]},
)
SCORES = ScoreSettings()
RISK = RiskSettings()


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def dirty_rows(events: DataFrame) -> DataFrame:
    """Every event, with missing, negative, late and unknown values, and some events twice."""
    n = F.col("event_id")

    def every(k: int):
        return F.pmod(n, F.lit(k)) == 0

    copies = F.sequence(F.lit(0), F.when(every(29), 1).otherwise(0))
    return events.select(
        "event_id",
        "user_id",
        F.when(every(31), None).when(every(37), F.col("ts") - F.expr("INTERVAL 2 DAYS")).otherwise(F.col("ts")).alias("ts"),
        F.when(every(17), None).when(every(23), -F.col("value")).otherwise(F.col("value")).alias("value"),
        F.when(every(41), "bogus").otherwise(F.col("event_type")).alias("event_type"),
        F.explode(copies).alias("copy"),
    ).select("event_id", "user_id", "ts", "value", "event_type", (n * 2 + F.col("copy")).alias("arrival"))


def dirty(spark: SparkSession, sf: str) -> DataFrame:
    return dirty_rows(table(spark, sf, "events"))


def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_readings(dirty(spark, sf), COLS, CHECKS.min_value, CHECKS.max_value)


def weather(spark: SparkSession, sf: str) -> DataFrame:
    """An hourly series taken from the events, playing the part of the weather."""
    kind, v = F.col("event_type"), F.col("value")
    return (
        table(spark, sf, "events")
        .groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("timestamp"))
        .agg(
            F.avg(F.when(kind == "view", v)).alias("temperature_celsius"),
            (F.avg(F.when(kind == "click", v)) / 499).alias("humidity_ratio"),
            F.max(kind).alias("weather_summary"),
        )
    )


def households(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as households, with categories that need tidying."""
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.when(F.col("c_acctbal") < 0, " tou ").otherwise("Std").alias("tariff_type"),
        F.concat(F.lit("ACORN-"), F.substring("c_mktsegment", 1, 1)).alias("acorn_code"),
        F.concat(F.lit(" "), F.col("c_mktsegment")).alias("acorn_group"),
    )


def tidy_households(spark: SparkSession, sf: str) -> DataFrame:
    return clean.standardise(households(spark, sf), upper=["tariff_type"], trimmed=["acorn_code", "acorn_group"])


def holidays(spark: SparkSession, sf: str) -> DataFrame:
    """Sundays with events."""
    days = table(spark, sf, "events").select(F.to_date("ts").alias("holiday_date")).distinct()
    return days.filter(F.dayofweek("holiday_date") == 1)


def readings_with_weather(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.enrich_hourly(cleaned(spark, sf), weather(spark, sf), "ts")


def scores(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.quality_scores(dirty(spark, sf), COLS, CHECKS, SCORES)


def incidents(spark: SparkSession, sf: str, all_rules: bool = False) -> DataFrame:
    return checks.all_incidents(dirty(spark, sf), COLS, CHECKS, all_rules)


def stored(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Scores and incidents, computed once and kept, as the layers keep them."""
    rows = checks.with_entity_stats(dirty(spark, sf), COLS)
    scored = scoring.quality_scores(dirty(spark, sf), COLS, CHECKS, SCORES, rows=rows)
    scored, found = durable_together(scored, checks.all_incidents(dirty(spark, sf), COLS, CHECKS, rows=rows))
    return scored, found


def feature_rows(spark: SparkSession, sf: str, exclude_current: bool = False, kept: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    scored, found = kept or stored(spark, sf)
    return features.features(
        scored,
        found,
        readings_with_weather(spark, sf),
        COLS,
        tidy_households(spark, sf).select("user_id", "tariff_type", "acorn_group"),
        holidays(spark, sf),
        RISK.windows,
        exclude_current,
    )


def label_rows(spark: SparkSession, sf: str, kept: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    scored, found = kept or stored(spark, sf)
    return features.labels(scored, found, COLS.entity, RISK, check=False)


def training_rows(spark: SparkSession, sf: str) -> DataFrame:
    kept = stored(spark, sf)
    return features.training_set(feature_rows(spark, sf, kept=kept), label_rows(spark, sf, kept), check=False)


def baseline(spark: SparkSession, sf: str) -> DataFrame:
    """A forecast without a model: tomorrow is as risky as today was bad."""
    keyed = features.keyed_scores(scores(spark, sf), COLS.entity)
    from sievewatt.functions.columns import risk_category

    return keyed.select(
        "entity_id",
        F.date_add("score_date", 1).alias("prediction_date"),
        (1 - F.col("quality_score") / 100).alias("risk_score"),
    ).withColumn("risk_category", risk_category(F.col("risk_score")))


def judged(spark: SparkSession, sf: str) -> DataFrame:
    """Baseline forecasts next to what happened."""
    kept = stored(spark, sf)
    forecast = features.keyed_scores(kept[0], COLS.entity).select(
        "entity_id", "score_date", (1 - F.col("quality_score") / 100).alias("risk_score")
    )
    return forecast.join(label_rows(spark, sf, kept).select("entity_id", "score_date", "target"), ["entity_id", "score_date"])


def newest(df: DataFrame, c: str):
    """The latest day of a column as a scalar subquery, so that no report depends on today."""
    return df.agg(F.max(F.to_date(c)).alias("d")).scalar()


def fresh(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, name)


def rounded(df: DataFrame, digits: int = 9) -> DataFrame:
    """Doubles to nine places and timestamps without a zone, as the SQL side has them."""
    out = []
    for f in df.schema.fields:
        kind, c = f.dataType.simpleString(), F.col(f"`{f.name}`")
        if kind == "double":
            out.append(F.round(c, digits).alias(f.name))
        elif kind == "timestamp":
            out.append(c.cast("timestamp_ntz").alias(f.name))
        else:
            out.append(c)
    return df.select(*out)
