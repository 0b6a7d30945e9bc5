"""One query per operator, on the provided tables."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import replace
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog import files, inputs
from catalog.inputs import CHECKS, COLS, RISK, SCORES, dirty, fresh, rounded, table
from sievewatt.functions import geometry as G
from sievewatt.functions.columns import micros
from sievewatt.governance import audit, lineage, schema
from sievewatt.operators import checks, clean, enrich, expectations, features, quantiles, scoring, spatial
from sievewatt.plans import layers, reports, training
from sievewatt.config import RiskSettings, Settings
from sievewatt.runtime import durable
from sievewatt.sources import geo, raw, sinks, tables
from sievewatt.streaming import checks as stream_checks
from sievewatt.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register under the function's name, with doubles rounded for comparison."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        return rounded(fn(spark, sf))

    REGISTRY[fn.__name__] = run
    return fn


# ---------------------------------------------------------------------- silver


@query
def clean_readings(spark, sf):
    return inputs.cleaned(spark, sf).drop("event_id", "arrival")


@query
def forward_fill(spark, sf):
    kept = clean.range_filter(clean.dedupe(dirty(spark, sf), ["user_id", "ts"], ["arrival"]), "value", 0.0, 100.0)
    return clean.forward_fill(kept, COLS, max_age_minutes=3 * 1440).select("user_id", "ts", "arrival", "value")


@query
def rejected_rows(spark, sf):
    return clean.rejected_readings(dirty(spark, sf), COLS, CHECKS.min_value, CHECKS.max_value)


@query
def missing_from_silver(spark, sf):
    lost = clean.missing_from(dirty(spark, sf), inputs.cleaned(spark, sf), ["user_id", "ts"])
    return lost.select("event_id", "user_id", "ts", "arrival")


@query
def enriched_readings(spark, sf):
    out = enrich.enrich_entities(
        dirty(spark, sf),
        inputs.households(spark, sf),
        ["user_id"],
        ["tariff_type", "acorn_code", "acorn_group"],
        upper=["tariff_type"],
    )
    return out.select("event_id", "arrival", "user_id", "tariff_type", "acorn_code", "acorn_group")


@query
def weather_enriched(spark, sf):
    return inputs.readings_with_weather(spark, sf).select(
        "user_id", "ts", "value", "temperature_celsius", "humidity_ratio", "weather_summary"
    )


def _household_enriched(spark, sf):
    return enrich.enrich_entities(
        inputs.cleaned(spark, sf), inputs.households(spark, sf), ["user_id"], ["acorn_group", "tariff_type"], upper=["tariff_type"]
    )


@query
def consumption_analytics(spark, sf):
    both = enrich.enrich_hourly(_household_enriched(spark, sf), inputs.weather(spark, sf), "ts")
    return enrich.consumption_analytics(both, COLS)


@query
def joined_enriched(spark, sf):
    return enrich.join_enriched(_household_enriched(spark, sf), inputs.readings_with_weather(spark, sf), COLS).select(
        "user_id", "ts", "value", "acorn_group", "temperature_celsius"
    )


# ---------------------------------------------------------------------- checks


@query
def completeness_daily(spark, sf):
    return checks.completeness(dirty(spark, sf), COLS, CHECKS.interval_minutes)[0]


@query
def completeness_weekly(spark, sf):
    return checks.completeness(dirty(spark, sf), COLS, CHECKS.interval_minutes, grain="week")[0]


@query
def completeness_spine(spark, sf):
    out = checks.completeness(dirty(spark, sf), COLS, CHECKS.interval_minutes, spine=True)[0]
    return out


@query
def temporal_metrics_open_arrivals(spark, sf):
    """Cadence where some readings have no arrival and copies share theirs."""
    rows = dirty(spark, sf)
    open_ = F.when(F.col("event_id") % 43 == 0, None).otherwise(F.col("arrival") - F.col("arrival") % 2)
    rows = rows.withColumn("arrival", open_)
    return checks.temporal(rows, COLS, CHECKS.interval_minutes, CHECKS.tolerance_minutes)[0].select(
        "user_id", "score_date", "total_records", "gap_count", "duplicate_count", "out_of_order_count", "anomalous_records"
    )


@query
def temporal_metrics(spark, sf):
    return checks.temporal(dirty(spark, sf), COLS, CHECKS.interval_minutes, CHECKS.tolerance_minutes)[0]


@query
def business_metrics(spark, sf):
    return checks.business(dirty(spark, sf), COLS, CHECKS.min_value, CHECKS.max_value, CHECKS.z_score)[0]


@query
def schema_metrics(spark, sf):
    return checks.schema_validity(dirty(spark, sf), COLS, CHECKS.enums, CHECKS.value_range)[0]


def _plain_evidence(found: DataFrame) -> DataFrame:
    """Numbers in the evidence to eight places, as the SQL side writes them."""
    plain = F.transform(F.split("evidence", "[|]"), lambda t: F.coalesce(F.round(t.try_cast("double"), 8).cast("string"), t))
    return found.withColumn("evidence", F.array_join(plain, "|"))


@query
def incidents_all(spark, sf):
    return _plain_evidence(inputs.incidents(spark, sf))


@query
def incidents_every_rule(spark, sf):
    return _plain_evidence(inputs.incidents(spark, sf, all_rules=True))


@query
def weather_correlation(spark, sf):
    return checks.weather_consistency(inputs.readings_with_weather(spark, sf), COLS, "temperature_celsius")[0]


@query
def weather_mismatches(spark, sf):
    found = checks.weather_consistency(inputs.readings_with_weather(spark, sf), COLS, "temperature_celsius")[1]
    return found.select("entity_id", "score_date", "rule_name")


@query
def expectations_suite(spark, sf):
    suite = expectations.readings_suite(COLS, CHECKS)
    more = expectations.in_set("event_type", CHECKS.enums["event_type"])
    return expectations.Suite((*suite.expectations, more)).validate(dirty(spark, sf))


REGISTRY["expectations"] = REGISTRY.pop("expectations_suite")

# ---------------------------------------------------------------------- scores


@query
def quality_scores(spark, sf):
    return inputs.scores(spark, sf)


@query
def scores_from_four_checks(spark, sf):
    df, c = dirty(spark, sf), CHECKS
    return scoring.score(
        checks.completeness(df, COLS, c.interval_minutes)[0],
        checks.temporal(df, COLS, c.interval_minutes, c.tolerance_minutes)[0],
        checks.business(df, COLS, c.min_value, c.max_value, c.z_score)[0],
        checks.schema_validity(df, COLS, c.enums, c.value_range)[0],
        COLS.entity,
        SCORES,
    )


@query
def score_rollup(spark, sf):
    grouped = enrich.enrich_entities(inputs.scores(spark, sf), inputs.households(spark, sf), ["user_id"], ["acorn_group"])
    return scoring.rollup(grouped, ["acorn_group"], "week")


@query
def score_summary(spark, sf):
    return scoring.summary(inputs.scores(spark, sf))


@query
def score_quantiles(spark, sf):
    return quantiles.quantiles(durable(inputs.scores(spark, sf)), "quality_score", [0.2, 0.3, 0.4, 0.5, 0.6, 0.7])


# --------------------------------------------------------------------- reports


def _dim(spark, sf):
    return inputs.tidy_households(spark, sf)


def _keyed(spark, sf):
    return inputs.scores(spark, sf).filter(F.col("score_date").isNotNull())


@query
def worst_group_days(spark, sf):
    scores = durable(_keyed(spark, sf))
    return reports.worst_group_days(scores, _dim(spark, sf), ["user_id"], "acorn_group", inputs.newest(scores, "score_date"))


@query
def incidents_daily(spark, sf):
    found = durable(inputs.incidents(spark, sf))
    return reports.incidents_by_day(found, inputs.newest(found, "incident_timestamp"))


@query
def incident_counts_by_rule(spark, sf):
    return reports.incidents_by_rule(inputs.incidents(spark, sf))


@query
def incident_pivot(spark, sf):
    return reports.severity_pivot(inputs.incidents(spark, sf))


@query
def incident_timeline(spark, sf):
    return reports.incident_timeline(inputs.incidents(spark, sf))


@query
def next_day_predictions(spark, sf):
    forecast = durable(inputs.baseline(spark, sf))
    return reports.predictions_for(forecast, inputs.newest(forecast, "prediction_date"))


@query
def high_risk_entities(spark, sf):
    dim = _dim(spark, sf).withColumn("entity_id", F.col("user_id").cast("string"))
    return reports.high_risk(inputs.baseline(spark, sf), dim, ["entity_id"], "acorn_group", cut=0.4)


@query
def worst_entities(spark, sf):
    return reports.worst_entities(inputs.scores(spark, sf), ["user_id"])


@query
def low_quality_entities(spark, sf):
    return reports.most_low_days(inputs.scores(spark, sf), _dim(spark, sf), ["user_id"], ["acorn_group", "tariff_type"])


@query
def segment_low_days(spark, sf):
    top = reports.most_low_days(inputs.scores(spark, sf), _dim(spark, sf), ["user_id"], ["acorn_group", "tariff_type"])
    return reports.low_days_by_group(top, "acorn_group")


@query
def score_histogram(spark, sf):
    return reports.histogram(inputs.scores(spark, sf), "quality_score", 0.0, 100.0)


@query
def score_categories(spark, sf):
    return reports.shares(inputs.scores(spark, sf), "quality_category")


@query
def score_statistics(spark, sf):
    return reports.statistics(durable(inputs.scores(spark, sf)), "quality_score", SCORES.low_quality_threshold)


@query
def daily_trend(spark, sf):
    return reports.daily_trend(inputs.scores(spark, sf))


@query
def scores_by_segment(spark, sf):
    return reports.scores_by_group(inputs.scores(spark, sf), _dim(spark, sf), ["user_id"], "acorn_group")


@query
def component_breakdown(spark, sf):
    return reports.component_breakdown(inputs.scores(spark, sf), SCORES.weights)


@query
def score_dates(spark, sf):
    return reports.score_dates(inputs.scores(spark, sf))


@query
def risk_histogram(spark, sf):
    return reports.histogram(inputs.baseline(spark, sf), "risk_score", 0.0, 1.0)


@query
def risk_categories(spark, sf):
    return reports.shares(inputs.baseline(spark, sf), "risk_category")


@query
def risk_statistics(spark, sf):
    return reports.statistics(durable(inputs.baseline(spark, sf)), "risk_score", step=0.001)


# ---------------------------------------------------------- features and labels


@query
def incident_features(spark, sf):
    return features.incident_counts(inputs.incidents(spark, sf))


@query
def consumption_features(spark, sf):
    return features.consumption_stats(inputs.readings_with_weather(spark, sf), COLS)


@query
def rolling_features(spark, sf):
    return inputs.feature_rows(spark, sf)


@query
def rolling_features_before_today(spark, sf):
    return inputs.feature_rows(spark, sf, exclude_current=True)


@query
def labels_next_day(spark, sf):
    return inputs.label_rows(spark, sf)


@query
def labels_median_threshold(spark, sf):
    return features.labels(
        *inputs.stored(spark, sf), COLS.entity, RISK, auto_median=True, any_incident=True
    ).select("entity_id", "score_date", "target")


@query
def training_set(spark, sf):
    return inputs.training_rows(spark, sf)


@query
def train_test_split(spark, sf):
    rows = durable(inputs.label_rows(spark, sf).select("entity_id", "score_date", "target"))
    return quantiles.stratified_split(rows, "target", features.KEYS, RISK.train_fraction, RISK.seed)


@query
def time_split(spark, sf):
    rows = inputs.label_rows(spark, sf).select("entity_id", "score_date", "target")
    return training.time_parts(durable(rows), RISK.train_fraction, 3)


@query
def ranking_metrics(spark, sf):
    return training.ranking(durable(inputs.judged(spark, sf)))


@query
def class_weights(spark, sf):
    return training.class_weights(inputs.label_rows(spark, sf))


@query
def confusion_counts(spark, sf):
    return training.confusion(inputs.judged(spark, sf), cut=0.3)


@query
def class_report(spark, sf):
    return training.class_report(inputs.judged(spark, sf), cut=0.3)


@query
def calibration(spark, sf):
    return training.calibration(inputs.judged(spark, sf))


def _trained(spark, sf, cfg: RiskSettings):
    """Fit on the split's training side; features are written once, since boosting reads them often."""
    path = fresh(spark, "training-set")
    rows = inputs.training_rows(spark, sf)
    tables.write(rows, path)
    stored = tables.read(spark, path)
    train_rows, test_rows = training.split(stored, cfg)
    model, numbers = training.train(train_rows, cfg, ["acorn_group", "tariff_type"])
    return model, numbers, test_rows


@query
def risk_predictions(spark, sf):
    model, numbers, _ = _trained(spark, sf, RISK)
    out = training.predict(model, inputs.feature_rows(spark, sf), numbers)
    return out.drop("top_features")


@query
def predicted_days(spark, sf):
    """Whom and which day the newest model and an earlier day's run score, and whether all scores are in their
    category; the scores themselves have no counterpart in SQL."""
    model, numbers, _ = _trained(spark, sf, RiskSettings(model_type="logistic_regression"))
    rows = durable(inputs.feature_rows(spark, sf))
    runs = [training.predict(model, rows, numbers, on_date=d) for d in (None, rows.agg(F.min("score_date")).first()[0])]
    score, category = F.col("risk_score"), F.col("risk_category")
    low, high = score < 0.3, score >= 0.7
    fits = F.when(low, category == "low").when(high, category == "high").otherwise(category == "medium")
    return runs[0].unionByName(runs[1]).select("entity_id", "prediction_date", (score.between(0, 1) & fits).alias("fits"))


@query
def prediction_reports(spark, sf):
    """How many rows the standing reports cover on a model's stored predictions of the newest and of the first day."""
    model, numbers, _ = _trained(spark, sf, RiskSettings(model_type="logistic_regression"))
    rows, target = durable(inputs.feature_rows(spark, sf)), fresh(spark, "predictions")
    for d in (None, rows.agg(F.min("score_date")).first()[0]):
        made = training.predict(model, rows, numbers, on_date=d).drop("top_features")
        sinks.replace_parts(made, target, ["prediction_date"])
    stored = sinks.read_parts(spark, target)
    named = {
        "categories": reports.shares(stored, "risk_category").agg(F.sum("rows").alias("rows")),
        "histogram": reports.histogram(stored, "risk_score", 0.0, 1.0).agg(F.sum("rows").alias("rows")),
        "statistics": reports.statistics(stored, "risk_score", step=0.001).select(F.col("total").alias("rows")),
        "newest_day": reports.predictions_for(stored, inputs.newest(stored, "prediction_date")).agg(F.count(F.lit(1)).alias("rows")),
    }
    frames = [df.select(F.lit(name).alias("report"), "rows") for name, df in named.items()]
    return reduce(DataFrame.unionByName, frames)


@query
def model_evaluation(spark, sf):
    model, numbers, test_rows = _trained(spark, sf, RiskSettings(model_type="logistic_regression"))
    path = fresh(spark, "models")
    found = training.evaluate(training.scored(model, test_rows, numbers))
    training.save_model(spark, model, numbers, found, path, "first")
    again, meta = training.load_model(spark, path)
    judged = training.scored(again, test_rows, meta["features"])
    return training.class_report(judged).withColumn("auc", F.lit(found["auc"]))


# ------------------------------------------------------------- versioned tables


def _slim(spark, sf):
    return table(spark, sf, "events").select("event_id", "user_id", "ts", "value")


@query
def version_compare(spark, sf):
    path, events = fresh(spark, "versions"), table(spark, sf, "events")
    tables.write(events.select("event_id", "user_id", "value"), path)
    later = events.filter(F.col("event_type") != "signup").select(
        "event_id", "user_id", F.when(F.col("event_type") == "error", F.col("value") + 1).otherwise(F.col("value")).alias("value")
    )
    tables.write(later, path)
    return tables.compare(spark, path, 0, 1, ["event_id"])


@query
def restore_version(spark, sf):
    path = fresh(spark, "restore")
    tables.write(_slim(spark, sf).drop("ts"), path)
    tables.write(table(spark, sf, "customer").select(F.col("c_custkey").alias("event_id")), path)
    tables.restore(spark, path, 0)
    return tables.read(spark, path)


@query
def version_history(spark, sf):
    path = fresh(spark, "history")
    tables.write(_slim(spark, sf), path)
    tables.write(_slim(spark, sf), path, mode="append")
    tables.restore(spark, path, 0)
    tables.optimize(spark, path)
    return tables.history(spark, path).select("version", "operation", "rows_written")


@query
def schema_evolution(spark, sf):
    path, events = fresh(spark, "evolution"), table(spark, sf, "events")
    schema.evolve(events.select("event_id", "value"), path)
    schema.evolve(events.select("event_id", F.col("event_id").cast("int").alias("value"), "event_type"), path, mode="merge")
    return tables.read(spark, path)


@query
def schema_diff(spark, sf):
    events = table(spark, sf, "events")
    other = events.select("event_id", F.col("user_id").cast("string").alias("user_id"), F.lit("x").alias("source"))
    return schema.schema_diff(events.select("event_id", "user_id", "value"), other)


@query
def zorder_rewrite(spark, sf):
    path = fresh(spark, "zorder")
    tables.write(_slim(spark, sf), path)
    tables.optimize(spark, path, zorder=["user_id", "ts"])
    return tables.read(spark, path)


# ------------------------------------------------------------------- raw files


@query
def csv_readings(spark, sf):
    return raw.read_readings(spark, files.readings_csv(spark, sf))


@query
def csv_daily(spark, sf):
    out = raw.read_daily(spark, files.daily_csv(spark, sf))
    return out.drop(*[c for c in out.columns if c.startswith("_")])


@query
def csv_weather_hourly(spark, sf):
    out = raw.read_weather_hourly(spark, files.weather_hourly_csv(spark, sf))
    return out.select("timestamp", "temperature_celsius", "humidity_ratio", "weather_summary")


@query
def csv_weather_daily(spark, sf):
    return raw.read_weather_daily(spark, files.weather_daily_csv(spark, sf))


@query
def csv_households(spark, sf):
    return raw.read_households(spark, files.households_csv(spark, sf))


@query
def csv_holidays(spark, sf):
    return raw.read_holidays(spark, files.holidays_csv(inputs.holidays(spark, sf))).select("holiday_date")


@query
def csv_segments(spark, sf):
    return raw.read_segments(spark, files.segments_csv(spark, sf))


@query
def optional_source(spark, sf):
    """An existing source, and a missing one in whose place comes the empty table."""
    there = files.holidays_csv(inputs.holidays(spark, sf))
    paths = {"there": there, "missing": f"{sf}/no-such-holidays.csv"}
    read = {n: raw.read_optional(lambda p=p: raw.read_holidays(spark, p), spark, raw.HOLIDAY_OUT) for n, p in paths.items()}
    return read["there"].select("holiday_date").unionByName(read["missing"])


# --------------------------------------------------------------------- streams


def _event_stream(spark, sf):
    """The events table as a file stream of several micro-batches, with the same faults added."""
    events = table(spark, sf, "events")
    folder, files_per_trigger = files.stream_files(events, "event_id")
    source = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)
    return inputs.dirty_rows(source)


# State on the executors' disks instead of their heaps; a micro-batch stores what it changed.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def _state_on_disk(spark):
    before = {key: spark.conf.get(key, None) for key in STATE}
    for key, value in STATE.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def _drain(df, spark, name, output_mode="append"):
    """Run a stream until its input is used up and return the rows it wrote."""
    target = fresh(spark, name)

    def number(batch: DataFrame, batch_id: int) -> None:
        sinks.replace_parts(batch.withColumn("_batch_no", F.lit(batch_id)), target, ["_batch_no"])

    out = df.writeStream.outputMode(output_mode).option("checkpointLocation", fresh(spark, f"{name}-checkpoint"))
    with _state_on_disk(spark):
        out.foreachBatch(number).trigger(availableNow=True).start().awaitTermination()
    return sinks.read_parts(spark, target)


@query
def stream_ingest(spark, sf):
    folder, target, checkpoint = files.readings_csv(spark, sf), fresh(spark, "bronze"), fresh(spark, "checkpoint")
    taken = files.blocks_per_trigger(spark, folder)
    for _ in range(2):  # a restart on the same checkpoint adds nothing
        ingest.write_stream(ingest.stream_readings(spark, folder, taken), target, checkpoint, trigger=None).awaitTermination()
    return sinks.read_parts(spark, target).select("household_id", "timestamp", "energy_kwh", "source_block")


@query
def stream_weather(spark, sf):
    folder, target = files.weather_hourly_csv(spark, sf), fresh(spark, "bronze-weather")
    weather = ingest.stream_weather(spark, folder, 8)
    ingest.write_stream(weather, target, fresh(spark, "checkpoint"), "weather_streaming", trigger=None).awaitTermination()
    return sinks.read_parts(spark, target).select("timestamp", "temperature_celsius", "humidity_ratio", "weather_summary")


@query
def replayed_batches(spark, sf):
    """Events in batches, one of them written again, as after a crash between write and checkpoint."""
    events, target = _slim(spark, sf).drop("ts"), fresh(spark, "replayed")
    batch = F.pmod("event_id", F.lit(3)).cast("int")
    for number in (0, 1, 1, 2, 0):
        sinks.replace_parts(events.filter(batch == number).withColumn("batch", F.lit(number)), target, ["batch"])
    return sinks.read_parts(spark, target)


@query
def repeated_predictions(spark, sf):
    """Forecasts stored day by day, the second run of a day with one column more."""
    target, forecast = fresh(spark, "predictions"), durable(inputs.baseline(spark, sf))
    days = [r[0] for r in forecast.select("prediction_date").distinct().orderBy(F.desc("prediction_date")).limit(2).collect()]
    for day, more in ((days[0], False), (days[-1], False), (days[0], True)):
        rows = forecast.filter(F.col("prediction_date") == day)
        sinks.replace_parts(rows.withColumn("model_version", F.lit("again")) if more else rows, target, ["prediction_date"])
    return sinks.read_parts(spark, target)


@query
def stream_dedupe(spark, sf):
    timed = _event_stream(spark, sf).filter(F.col("ts").isNotNull())
    return _drain(stream_checks.stream_dedupe(timed, COLS, "40 days"), spark, "dedupe").select("user_id", "ts")


@query
def stream_completeness(spark, sf):
    counts = stream_checks.stream_completeness(_event_stream(spark, sf), COLS, "40 days", CHECKS)
    return stream_checks.newest_results(_drain(counts, spark, "completeness", "update"), ["user_id", "score_date"])


@query
def stream_cadence(spark, sf):
    judged = stream_checks.stream_cadence(_event_stream(spark, sf), COLS, CHECKS.interval_minutes, CHECKS.tolerance_minutes)
    out = _drain(judged, spark, "cadence")
    return out.groupBy("user_id", "cadence").agg(F.count(F.lit(1)).alias("rows"))


# ------------------------------------------------------------------- geography


def _areas(spark, sf):
    return geo.admin_areas(spark, files.areas_geojson(spark, sf), 3)


@query
def admin_areas(spark, sf):
    return _areas(spark, sf).select(
        "gid_3",
        "country",
        "region",
        "county",
        "district",
        "admin_level",
        F.size("rings").alias("ring_count"),
        G.ring_area(F.element_at("rings", 1)).alias("outer_area"),
    )


@query
def admin_areas_level2(spark, sf):
    """The same areas from collections, as level 2."""
    areas = geo.admin_areas(spark, files.areas_geojson(spark, sf, 2, collection=True), 2)
    return areas.select("gid_2", "country", "region", "county", "admin_level", F.size("rings").alias("ring_count"))


@query
def osm_buildings(spark, sf):
    found = geo.osm_buildings(spark, files.buildings_xml(spark, sf), ["building", "landuse"])
    return found.select(
        "building_id",
        "building_type",
        "landuse",
        F.round("area_m2", 3).alias("area_m2"),
        F.size(F.element_at("rings", 1)).alias("corners"),
        "missing_nodes",
        F.col("osm_tags")["source"].alias("source"),
    )


@query
def points_in_areas(spark, sf):
    middle = G.centroid(F.element_at("rings", 1))
    points = files.building_rows(spark, sf).select(
        F.substring("building_id", 5, 20).cast("long").alias("building_key"), middle["x"].alias("x"), middle["y"].alias("y")
    )
    areas = _areas(spark, sf).select(F.col("gid_3").alias("area_id"), "rings")
    return spatial.points_within(points, areas, 0.25).select("building_key", "area_id")


@query
def areas_touching(spark, sf):
    """Areas and zones that share a point; whether their boundaries do, or one holds the other."""
    areas = spatial.named_areas(_areas(spark, sf)).select("area_id", "rings")
    return spatial.areas_touching(areas, files.zone_rows(spark, sf), 0.25)


@query
def areas_without_ids(spark, sf):
    """Buildings per area where the areas have names but no ids and get numbers."""
    totals = spatial.buildings_by_area(files.building_rows(spark, sf), _areas(spark, sf).drop("gid_3"), 0.25)
    return totals.withColumn("total_area_m2", F.round("total_area_m2", 2))


def _totals(spark, sf):
    totals = spatial.buildings_by_area(files.building_rows(spark, sf), _areas(spark, sf), 0.25)
    return totals.withColumn("total_area_m2", F.round("total_area_m2", 2))


@query
def buildings_by_area(spark, sf):
    return _totals(spark, sf)


@query
def top_areas(spark, sf):
    return reports.top_areas(_totals(spark, sf))


# ------------------------------------------------------------------ whole runs


def _lake(spark, sf):
    """Settings of a lake in a fresh folder, with the provided tables as raw files."""
    root = fresh(spark, "lake")
    return Settings(
        paths={
            "household_info": files.households_csv(spark, sf),
            "acorn_details": files.segments_csv(spark, sf),
            "halfhourly_dir": files.readings_csv(spark, sf),
            "daily_dir": files.daily_csv(spark, sf),
            "weather_hourly": files.weather_hourly_csv(spark, sf),
            "weather_daily": files.weather_daily_csv(spark, sf),
            "bank_holidays": files.holidays_csv(inputs.holidays(spark, sf)),
            "areas_level3": files.areas_geojson(spark, sf),
            "osm_xml": files.buildings_xml(spark, sf),
            "bronze_root": f"{root}/bronze",
            "silver_root": f"{root}/silver",
            "gold_root": f"{root}/gold",
        },
        checks=CHECKS,
        limit_blocks=None,
    )


def _short(c: str):
    """``layer/table`` of a path; of a raw file the name without the number of its folder."""
    return F.regexp_replace(F.regexp_extract(c, r"((?:bronze|silver|gold)/)?[^/]+$", 0), "-[0-9a-f]{32}$", "").alias(c)


@query
def layer_run(spark, sf):
    """Raw files to gold in one run; the rows of every table it wrote, from the audit log."""
    settings = _lake(spark, sf)
    layers.run_batch(spark, settings)
    runs = audit.query_runs(spark, f"{settings.paths['gold_root']}/audit_log", "batch_run", limit=1)
    return runs.select("status", F.explode("row_counts").alias("table", "rows")).select("status", _short("table"), "rows")


def _runs(spark, sf):
    """The audit log of two runs of one lake: a whole one, and one whose readings are missing."""
    settings = _lake(spark, sf)
    layers.run_batch(spark, settings)
    gone = {**settings.paths, "halfhourly_dir": f"{settings.paths['halfhourly_dir']}-gone"}
    try:
        layers.run_batch(spark, replace(settings, paths=gone))
    except ValueError:
        pass  # the log tells of it
    return f"{settings.paths['gold_root']}/audit_log"


@query
def latest_run(spark, sf):
    """The run without readings: its other sources were stored all the same."""
    return reports.latest_run(tables.read(spark, _runs(spark, sf))).withColumn("table", _short("table"))


@query
def audit_runs(spark, sf):
    """Of the run that succeeded: versions read and written, and rows, per table."""
    found = audit.query_runs(spark, _runs(spark, sf), "batch_run", "SUCCESS")
    per_table = found.select("pipeline_name", "status", "input_versions", "output_versions", F.explode("row_counts").alias("table", "rows"))
    return per_table.select(
        "pipeline_name", "status", _short("table"), "rows",
        F.try_element_at("input_versions", F.col("table")).alias("version_read"),
        F.try_element_at("output_versions", F.col("table")).alias("version_written"),
    )


@query
def run_lineage(spark, sf):
    """For every file and table: the tables made of it, directly or not, over both runs."""
    log = tables.read(spark, _runs(spark, sf))
    made = lineage.edges(log)
    starts = made.select(F.col("source").alias("path"), F.col("source_version").alias("version"))
    found = lineage.reached(made, starts)
    rows = log.select("output_versions", F.explode("row_counts").alias("path", "rows"))
    rows = rows.select("path", "rows", F.try_element_at("output_versions", F.col("path")).alias("version"))
    counted = found.join(rows.distinct(), ["path", "version"], "left")
    return counted.select(_short("start"), "start_version", _short("path"), "version", "steps", "rows")


def queries() -> dict[str, Query]:
    return dict(REGISTRY)
