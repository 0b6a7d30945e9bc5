"""The layer runs: raw files to bronze, cleaned silver, trusted gold, with an audit row per run."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import asdict
from datetime import date, datetime, timezone
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from sievewatt.config import Cols, Settings
from sievewatt.governance import audit
from sievewatt.operators.checks import all_incidents, completeness, with_entity_stats
from sievewatt.operators.clean import clean_readings, rejected_readings
from sievewatt.operators.enrich import consumption_analytics, enrich_entities, enrich_hourly
from sievewatt.operators.features import features, labels, training_set
from sievewatt.operators.scoring import quality_scores, summary
from sievewatt.operators.spatial import buildings_by_area
from sievewatt.plans import training
from sievewatt.sources import geo, raw, sinks, tables
from sievewatt.streaming.ingest import stream_readings, stream_weather, write_stream

READINGS = Cols()

# Side of a grid cell of the spatial join, in degrees; a district spans a few of them.
CELL_DEGREES = 0.05


def streamed_path(path: str) -> str:
    """Where streams put what belongs to the table at ``path``."""
    return f"{path}_stream"


class Run:
    """What one run read and wrote, for its audit row."""

    def __init__(self, spark: SparkSession, settings: Settings):
        self.spark, self.settings = spark, settings
        self.batch_id = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f")
        self.row_counts: dict[str, int] = {}
        self.read: dict[str, int] = {}
        self.streamed: set[str] = set()
        self.written: dict[str, int] = {}
        self.outputs: dict[str, str] = {}
        self.lineage: list[tuple[str, int | None, str, int | None]] = []
        self.skipped: list[str] = []
        self.scores: dict[str, float] = {}

    def path(self, layer: str, table: str) -> str:
        return f"{self.settings.paths[f'{layer}_root'].rstrip('/')}/{table}"

    def paths(self, *names: str) -> list[str]:
        """The paths of tables named ``layer/table``."""
        return [self.path(*name.split("/")) for name in names]

    def save(self, df: DataFrame, layer: str, table: str, sources: Sequence[str] = (), **options: Any) -> DataFrame:
        """Write a table made of ``sources`` (paths) and read it back; its rows are counted by the write itself."""
        path = self.path(layer, table)
        cfg = self.settings
        if cfg.evolution_mode != "overwrite" and tables.exists(self.spark, path):
            check_columns(tables.read(self.spark, path).schema, df.schema, cfg.evolution_mode, cfg.allow_additional_columns)
        number = tables.write(df, path, **options)
        self.made(f"{layer}_{table}", path, number, tables.rows_written(self.spark, path), sources)
        return self.load(layer, table)

    def made(self, name: str, path: str, number: int | None, rows: int, sources: Sequence[str]) -> None:
        """Note a table that is written: its version, its rows, and what it was made of."""
        if number is not None:
            self.written[path] = number
        self.row_counts[path] = rows
        self.outputs[name] = path
        for source in sources:
            self.lineage.append((path, number, source, self.written.get(source, self.read.get(source))))
            if source in self.streamed:
                self.lineage.append((path, number, streamed_path(source), None))

    def load(self, layer: str, table: str) -> DataFrame:
        """A table with what streams added to it. One run reads one version of a table, or the one it wrote itself."""
        path = self.path(layer, table)
        streamed = streamed_path(path)
        number = self.written.get(path, self.read.get(path))
        if number is None:
            number = tables.latest(self.spark, path)
        if number is not None:
            self.read[path] = number
        if not sinks.exists(self.spark, streamed):
            return tables.read(self.spark, path, number)
        self.streamed.add(path)
        added = sinks.read_parts(self.spark, streamed)
        if number is None:
            return added
        return tables.read(self.spark, path, number).unionByName(added, allowMissingColumns=True)

    def ingest(self, df: DataFrame, table: str, source: str, **options: Any) -> DataFrame:
        return self.save(raw.with_ingest_metadata(df, source, self.batch_id), "bronze", table, [source], **options)

    def together(self, steps: Mapping[str, Callable[[], Any]], optional: Sequence[str] = ()) -> None:
        """Run steps that do not need each other at once, each in a scheduler pool of its own.

        All end before this returns, so a step that fails does not hold up the others. What made an optional step fail is
        recorded for the audit row; of the other failures the first in the given order is raised.
        """

        def start(name: str, step: Callable[[], Any]) -> Callable[[], Any]:
            @inheritable_thread_target(self.spark)
            def run() -> None:
                # a thread of the pool may still carry the last step's name
                self.spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
                step()

            return run

        with ThreadPoolExecutor(max(1, min(len(steps), self.settings.steps_at_once))) as threads:
            ends = {name: threads.submit(start(name, step)) for name, step in steps.items()}
        failed = {name: end.exception() for name, end in ends.items() if end.exception()}
        self.skipped += [f"{name}: {err}" for name, err in failed.items() if name in optional]
        for name, err in failed.items():
            if name not in optional:
                raise err

    @contextmanager
    def logged(self, name: str) -> Iterator[None]:
        """Always leave an audit row behind; an error is raised again after it."""
        status, error = "SUCCESS", None
        try:
            yield
            if self.skipped:
                status, error = "PARTIAL", "; ".join(self.skipped)
        except Exception as err:
            status, error = "FAILED", str(err)
            raise
        finally:
            bronze_path, silver_path = self.paths("bronze/halfhourly_consumption", "silver/halfhourly_consumption")
            counts, log = self.row_counts, self.path("gold", "audit_log")
            audit.log_run(
                self.spark,
                log,
                name,
                asdict(self.settings),
                input_versions={source: n for _, _, source, n in self.lineage if n is not None},
                output_versions=self.written,
                output_paths=self.outputs,
                row_counts=counts,
                rejected_rows=counts[bronze_path] - counts[silver_path] if silver_path in counts else 0,
                quality_score_summary=self.scores,
                status=status,
                error_message=error,
                lineage=self.lineage,
            )
            audit.apply_retention(self.spark, log, self.settings.audit_retention_days)


def check_columns(old: StructType, new: StructType, mode: str, allow_new: bool) -> None:
    """``fail`` refuses a table whose columns went or changed their type; both modes refuse new ones unless allowed."""
    before, after = ({f.name: f.dataType for f in s.fields} for s in (old, new))
    gone = sorted(before.keys() - after.keys()) if mode == "fail" else []
    retyped = sorted(n for n in before.keys() & after.keys() if before[n] != after[n]) if mode == "fail" else []
    added = [] if allow_new else sorted(after.keys() - before.keys())
    if gone or retyped or added:
        raise ValueError(f"columns removed: {gone}, with another type: {retyped}, new: {added}")


def bronze(run: Run) -> None:
    """All sources at once. The geographic ones may fail."""
    run.together(sources(run) | geography(run), optional=list(geography(run)))


def sources(run: Run) -> dict[str, Callable[[], Any]]:
    """A step per source of readings, households, weather and holidays that the settings name."""
    spark, paths, limit = run.spark, run.settings.paths, run.settings.limit_blocks
    steps: dict[str, Callable[[], Any]] = {}

    def source(name: str, table: str, read: Callable[[str], DataFrame], needed: bool = False) -> None:
        if needed or name in paths:
            steps[table] = lambda: run.ingest(read(paths[name]), table, paths[name])

    def blocks(name: str, table: str, read: Callable[[str], DataFrame], needed: bool = False) -> None:
        """A folder per block if blocks are large. Of small ones, each file holds the blocks that its task has read:
        every read of the table lists all its folders and opens all its files."""

        def step() -> None:
            rows = read(paths[name])
            if raw.fills_folders(spark, paths[name]):
                run.ingest(rows, table, paths[name], partition_by=["source_block"])
            else:
                # a folder has no empty name either
                run.ingest(rows.withColumn("source_block", F.nullif("source_block", F.lit(""))), table, paths[name])

        if needed or name in paths:
            steps[table] = step

    def holidays(path: str) -> DataFrame:
        return raw.read_optional(lambda: raw.read_holidays(spark, path), spark, raw.HOLIDAY_OUT)

    source("household_info", "household_info", lambda p: raw.read_households(spark, p), needed=True)
    source("acorn_details", "acorn_details", lambda p: raw.read_segments(spark, p))
    blocks("halfhourly_dir", "halfhourly_consumption", lambda p: raw.read_readings(spark, p, limit), needed=True)
    source("weather_hourly", "weather_hourly", lambda p: raw.read_weather_hourly(spark, p), needed=True)
    source("weather_daily", "weather_daily", lambda p: raw.read_weather_daily(spark, p))
    blocks("daily_dir", "daily_consumption", lambda p: raw.read_daily(spark, p, limit))
    source("bank_holidays", "bank_holidays", holidays)
    return steps


def geography(run: Run) -> dict[str, Callable[[], Any]]:
    """A step per geographic source; where the buildings fail, an empty table takes their place."""
    spark, cfg = run.spark, run.settings

    def areas(level: int) -> None:
        path = cfg.paths[f"areas_level{level}"]
        run.save(geo.admin_areas(spark, path, level, cfg.crs), "bronze", f"gadm_level{level}", [path])

    def buildings() -> None:
        path = cfg.paths["osm_xml"]
        try:
            df = geo.osm_buildings(spark, path, cfg.building_tags, cfg.min_building_area, cfg.crs)
            run.save(df, "bronze", "osm_buildings", [path])
        except Exception:
            run.save(geo.no_buildings(spark), "bronze", "osm_buildings")
            raise

    steps: dict[str, Callable[[], Any]] = {
        f"areas level {n}": lambda n=n: areas(n) for n in (2, 3) if f"areas_level{n}" in cfg.paths
    }
    return steps | ({"buildings": buildings} if "osm_xml" in cfg.paths else {})


def silver(run: Run) -> None:
    cfg = run.settings.checks
    cleaned = clean_readings(run.load("bronze", "halfhourly_consumption"), READINGS, cfg.min_value, cfg.max_value)
    typed = cleaned.select(
        F.col("household_id").cast("string").alias("household_id"),
        F.col("timestamp").cast("timestamp").alias("timestamp"),
        F.col("energy_kwh").cast("double").alias("energy_kwh"),
        F.col("date").cast("date").alias("date"),
        *[F.col(c).cast("int").alias(c) for c in ("hour", "day_of_week", "day_of_month", "month", "year")],
        F.col("source_block").cast("string").alias("source_block"),
        F.col("_ingestion_timestamp").cast("timestamp").alias("_ingestion_timestamp"),
        F.col("_source").cast("string").alias("_source"),
        "_silver_processed",
    )
    raw_readings = run.paths("bronze/halfhourly_consumption")
    readings = run.save(typed, "silver", "halfhourly_consumption", raw_readings, partition_by=["year", "month"])
    by_month = {"partition_by": ["year", "month"]}

    def rejected() -> None:
        out = rejected_readings(run.load("bronze", "halfhourly_consumption"), READINGS, cfg.min_value, cfg.max_value)
        run.save(out, "silver", "rejected_readings", raw_readings)

    def households() -> None:
        attributes = ["tariff_type", "acorn_code", "acorn_group"]
        out = enrich_entities(readings, run.load("bronze", "household_info"), ["household_id"], attributes, upper=["tariff_type"])
        run.save(out, "silver", "household_enriched", run.paths("silver/halfhourly_consumption", "bronze/household_info"), **by_month)

    def weather() -> None:
        out = enrich_hourly(readings, run.load("bronze", "weather_hourly"), "timestamp")
        run.save(out, "silver", "weather_enriched", run.paths("silver/halfhourly_consumption", "bronze/weather_hourly"), **by_month)

    run.together({"rejected": rejected, "households": households, "weather": weather})


def quality(run: Run) -> None:
    readings, made_of = run.load("silver", "household_enriched"), run.paths("silver/household_enriched")
    cfg, rows = run.settings.checks, with_entity_stats(readings, READINGS)

    def scores() -> None:
        out = quality_scores(readings, READINGS, cfg, run.settings.scoring, rows=rows)
        kept = run.save(out, "gold", "quality_scores", made_of)
        run.scores = summary(kept).first().asDict()

    def incidents() -> None:
        run.save(all_incidents(readings, READINGS, cfg, rows=rows), "gold", "quality_incidents", made_of)

    def weekly() -> None:
        found = completeness(readings, READINGS, cfg.interval_minutes, cfg.weekly_missing, "week", critical=cfg.critical_missing)
        run.save(found[1], "gold", "weekly_completeness_incidents", made_of)

    run.together({"scores": scores, "incidents": incidents, "weekly": weekly})


def gold(run: Run) -> None:
    """Daily analytics straight from one enriched frame: the two silver tables hold the same
    readings, so joining them again would only shuffle both."""

    def analytics() -> None:
        with_weather = enrich_hourly(run.load("silver", "household_enriched"), run.load("bronze", "weather_hourly"), "timestamp")
        made_of = run.paths("silver/household_enriched", "bronze/weather_hourly")
        run.save(consumption_analytics(with_weather, READINGS), "gold", "consumption_analytics", made_of)

    def copied(name: str) -> None:
        run.save(run.load("bronze", name), "gold", name, run.paths(f"bronze/{name}"))

    names = [n for n in ("gadm_level2", "gadm_level3", "osm_buildings") if tables.exists(run.spark, run.path("bronze", n))]
    run.together({"analytics": analytics} | {n: lambda n=n: copied(n) for n in names})
    if "gadm_level3" in names and "osm_buildings" in names:
        totals = buildings_by_area(run.load("gold", "osm_buildings"), run.load("gold", "gadm_level3"), CELL_DEGREES)
        run.save(totals, "gold", "building_aggregations", run.paths("gold/osm_buildings", "gold/gadm_level3"))


def run_batch(spark: SparkSession, settings: Settings) -> bool:
    """Bronze to gold. An audit row is always written; an error is raised again after it.

    Geographic inputs may fail: the run then ends as PARTIAL.
    """
    run = Run(spark, settings)
    with run.logged("batch_run"):
        for layer in (bronze, silver, quality, gold):
            layer(run)
    return True


def run_stream(spark: SparkSession, settings: Settings, wait: bool = True, once: bool = False) -> StreamingQuery:
    """Stream new reading files into bronze; ``once`` takes what is there and stops."""
    paths = settings.paths
    query = write_stream(
        stream_readings(spark, paths["streaming_source"], settings.max_files_per_trigger),
        streamed_path(f"{paths['bronze_root'].rstrip('/')}/halfhourly_consumption"),
        paths["streaming_checkpoint"],
        trigger=None if once else settings.trigger_interval,
    )
    if wait:
        query.awaitTermination()
    return query


def run_weather_stream(spark: SparkSession, settings: Settings, wait: bool = True, once: bool = False) -> StreamingQuery:
    """Stream new weather files into bronze."""
    paths = settings.paths
    query = write_stream(
        stream_weather(spark, paths["streaming_weather"], settings.max_files_per_trigger),
        streamed_path(f"{paths['bronze_root'].rstrip('/')}/weather_hourly"),
        paths["streaming_weather_checkpoint"],
        "weather_streaming",
        trigger=None if once else settings.trigger_interval,
    )
    if wait:
        query.awaitTermination()
    return query


def risk_features(run: Run) -> DataFrame:
    """Features from the gold tables, with weather, segment, tariff and holidays."""
    readings = run.load("silver", "weather_enriched")
    dims = run.load("bronze", "household_info").select("household_id", "tariff_type", "acorn_group")
    return features(
        run.load("gold", "quality_scores"),
        run.load("gold", "quality_incidents"),
        readings,
        READINGS,
        dims,
        run.load("bronze", "bank_holidays") if _has_holidays(run) else None,
        run.settings.risk.windows,
    )


def _has_holidays(run: Run) -> bool:
    return tables.exists(run.spark, run.path("bronze", "bank_holidays"))


def _feature_sources(run: Run) -> list[str]:
    names = ["gold/quality_scores", "gold/quality_incidents", "silver/weather_enriched", "bronze/household_info"]
    return run.paths(*names, *(["bronze/bank_holidays"] if _has_holidays(run) else []))


def train_risk(spark: SparkSession, settings: Settings, auto_median: bool = False) -> tuple[Any, dict[str, Any]]:
    """Fit, judge and save the risk model; returns it with its metrics."""
    run, cfg = Run(spark, settings), settings.risk
    with run.logged("risk_training"):
        labelled = labels(
            run.load("gold", "quality_scores"), run.load("gold", "quality_incidents"), READINGS.entity, cfg, auto_median
        )
        # Kept once: the split, the weights, boosting and the report all read it.
        rows = run.save(training_set(risk_features(run), labelled), "gold", "risk_training_set", _feature_sources(run))
        train_rows, test_rows = training.split(rows, cfg)
        model, numbers = training.train(train_rows, cfg, categories=["acorn_group", "tariff_type"])
        metrics = training.evaluate(training.scored(model, test_rows, numbers))
        metrics["model_version"] = training.save_model(spark, model, numbers, metrics, cfg.model_path)
        run.lineage.append((cfg.model_path, None, *run.paths("gold/risk_training_set"), run.written[run.path("gold", "risk_training_set")]))
    return model, metrics


def predict_risk(spark: SparkSession, settings: Settings, on_date: date | str | None = None) -> DataFrame:
    """Score one day (default: the latest) with the newest model and store the predictions.

    The table keeps every day's predictions; a day that is predicted again replaces its own.
    """
    run = Run(spark, settings)
    path = run.path("gold", "quality_risk_predictions")
    with run.logged("risk_prediction"):
        model, meta = training.load_model(spark, settings.risk.model_path)
        out = training.predict(
            model, risk_features(run), meta["features"], meta["model_version"], meta["importances"], on_date
        ).withColumnRenamed("entity_id", "household_id")
        rows = sinks.replace_parts(out, path, ["prediction_date"])
        run.made("gold_quality_risk_predictions", path, None, rows, [*_feature_sources(run), settings.risk.model_path])
    stored = sinks.read_parts(spark, path)
    if on_date is None:
        return stored.join(F.broadcast(stored.agg(F.max("prediction_date").alias("prediction_date"))), "prediction_date", "left_semi")
    return stored.filter(F.col("prediction_date") == F.date_add(F.lit(str(on_date)).cast("date"), 1))
