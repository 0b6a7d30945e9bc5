import os
from datetime import datetime, timedelta

import pytest

from sievewatt.config import RiskSettings, Settings
from sievewatt.governance import audit, lineage
from sievewatt.plans import layers
from sievewatt.sources import sinks, tables

HOUSES = ["H1", "H2", "H3", "H4"]
DAYS = 12


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)
    return path


def reading_lines():
    lines = []
    for h, house in enumerate(HOUSES):
        for i in range(DAYS * 48):
            day = i // 48
            # Some days of some houses lose half of their readings.
            if (day * 7 + h * 3) % 5 == 0 and i % 2:
                continue
            at = datetime(2013, 1, 1) + timedelta(minutes=30 * i)
            value = "Null" if i % 97 == 0 else "-1" if i % 211 == 5 else "80" if i % 301 == 9 else f" {0.1 + (i % 48) / 100:.2f} "
            lines.append(f"{house},{at:%Y-%m-%d %H:%M:%S}.0000000,{value}")
    return lines


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    head = "LCLid,tstp,energy(kWh/hh)\n"
    lines = reading_lines()
    half = len(lines) // 2
    put(root + "/blocks", "block_0.csv", head + "\n".join(lines[:half]) + "\n")
    put(root + "/blocks", "block_1.csv", head + "\n".join(lines[half:]) + "\n")
    houses = "LCLid,stdorToU,Acorn,Acorn_grouped,file\n" + "".join(
        f"{h},{'Std' if i % 2 else 'ToU'},ACORN-{i},{'Affluent' if i % 2 else 'Adversity'},block_0\n" for i, h in enumerate(HOUSES)
    )
    weather = "time,temperature,apparentTemperature,humidity,pressure,windSpeed,windBearing,visibility,dewPoint,precipType,icon,summary\n"
    for i in range(DAYS * 24):
        at = datetime(2013, 1, 1) + timedelta(hours=i)
        weather += f"{at:%Y-%m-%d %H:%M:%S},{i % 24},{i % 24},0.5,1000,1,1,1,1,rain,i,s\n"
    paths = {
        "household_info": put(root, "houses.csv", houses),
        "acorn_details": put(root, "acorn.csv", "MAIN CATEGORIES,ACORN-A\nx,1\n"),
        "halfhourly_dir": root + "/blocks",
        "weather_hourly": put(root, "weather.csv", weather),
        "weather_daily": put(root, "daily.csv", "time,temperatureMax\n2013-01-01 00:00:00,5\n"),
        "bank_holidays": put(root, "holidays.csv", "Bank holidays,Type\n2013-01-01,New Year\n"),
        "osm_xml": root + "/no-such.osm",
        "bronze_root": root + "/bronze",
        "silver_root": root + "/silver",
        "gold_root": root + "/gold",
        "streaming_source": root + "/incoming",
        "streaming_checkpoint": root + "/checkpoint",
        "streaming_weather": root + "/incoming-weather",
        "streaming_weather_checkpoint": root + "/checkpoint-weather",
    }
    risk = RiskSettings(max_iter=5, min_instances=2, low_quality_threshold=90.0, model_path=root + "/models")
    settings = Settings(paths=paths, risk=risk, limit_blocks=None)
    assert layers.run_batch(spark, settings)
    return settings


def gold(spark, settings, name, layer="gold"):
    return tables.read(spark, f"{settings.paths[f'{layer}_root']}/{name}")


def test_batch_run_fills_the_layers(spark, lake):
    bronze, silver = gold(spark, lake, "halfhourly_consumption", "bronze"), gold(spark, lake, "halfhourly_consumption", "silver")
    assert bronze.count() == len(reading_lines())
    assert silver.filter("energy_kwh < 0 or energy_kwh > 50 or energy_kwh is null").count() == 0
    assert silver.groupBy("household_id").count().count() == len(HOUSES)
    scores = gold(spark, lake, "quality_scores")
    assert scores.count() == len(HOUSES) * DAYS
    assert scores.filter("quality_score < 0 or quality_score > 100").count() == 0
    analytics = gold(spark, lake, "consumption_analytics")
    assert analytics.count() == len(HOUSES) * DAYS
    assert analytics.filter("avg_temperature_celsius is null or tariff_type not in ('STD', 'TOU')").count() == 0
    tariffs = gold(spark, lake, "quality_incidents").filter("rule_name = 'schema_invalid_tariff'")
    assert tariffs.count() == 0


def test_rejects_sources_and_weekly_alerts_are_kept(spark, lake):
    bronze, silver = gold(spark, lake, "halfhourly_consumption", "bronze"), gold(spark, lake, "halfhourly_consumption", "silver")
    rejected = gold(spark, lake, "rejected_readings", "silver").agg({"row_count": "sum"}).first()[0]
    assert rejected == bronze.count() - silver.count()
    assert {r[0] for r in bronze.select("_source").distinct().collect()} == {lake.paths["halfhourly_dir"]}
    weekly = gold(spark, lake, "weekly_completeness_incidents")
    assert all(r["rule_name"].startswith("completeness") for r in weekly.collect())


def test_a_failed_optional_input_makes_the_run_partial(spark, lake):
    run = audit.query_runs(spark, lake.paths["gold_root"] + "/audit_log").first()
    assert run["status"] == "PARTIAL" and "buildings" in run["error_message"]
    bronze, silver = (run["row_counts"][f"{lake.paths[f'{n}_root']}/halfhourly_consumption"] for n in ("bronze", "silver"))
    assert run["rejected_rows"] == bronze - silver > 0
    assert run["quality_score_summary"]["max_quality_score"] <= 100
    assert gold(spark, lake, "osm_buildings", "bronze").count() == 0


def test_a_failed_run_is_logged_and_raised(spark, lake, tmp_path):
    paths = {**lake.paths, "halfhourly_dir": str(tmp_path / "none"), "gold_root": str(tmp_path / "gold"), "bronze_root": str(tmp_path / "b")}
    with pytest.raises(ValueError, match="no block"):
        layers.run_batch(spark, Settings(paths=paths))
    run = audit.query_runs(spark, str(tmp_path / "gold") + "/audit_log").first()
    assert run["status"] == "FAILED" and "no block" in run["error_message"]


def test_train_and_predict(spark, lake):
    model, metrics = layers.train_risk(spark, lake)
    assert 0 <= metrics["auc"] <= 1
    out = layers.predict_risk(spark, lake)
    assert sorted(r["household_id"] for r in out.collect()) == HOUSES
    assert {str(r["prediction_date"]) for r in out.collect()} == {"2013-01-13"}
    earlier = layers.predict_risk(spark, lake, "2013-01-05")
    assert {str(r["prediction_date"]) for r in earlier.collect()} == {"2013-01-06"}
    layers.predict_risk(spark, lake, "2013-01-05")
    path = lake.paths["gold_root"] + "/quality_risk_predictions"
    stored = sinks.read_parts(spark, path)
    assert stored.count() == 2 * len(HOUSES)
    log = lake.paths["gold_root"] + "/audit_log"
    predicted = audit.query_runs(spark, log, "risk_prediction", "SUCCESS")
    assert [r["row_counts"][path] for r in predicted.collect()] == [len(HOUSES)] * 3
    made = lineage.edges(tables.read(spark, log))
    start = spark.createDataFrame([(lake.paths["weather_hourly"],)], "path string")
    follows = {r["path"]: r["steps"] for r in lineage.reached(made, start, versions=False).collect()}
    assert follows[lake.paths["gold_root"] + "/risk_training_set"] == 3
    assert follows[path] == 3 and follows[lake.risk.model_path] == 4


def test_stream_run_appends_to_bronze(spark, lake):
    before = gold(spark, lake, "halfhourly_consumption", "bronze").count()
    put(lake.paths["streaming_source"], "block_9.csv", "LCLid,tstp,energy(kWh/hh)\nH9,2013-02-01 00:00:00.0000000,1.0\n")
    layers.run_stream(spark, lake, once=True)
    bronze = layers.Run(spark, lake).load("bronze", "halfhourly_consumption")
    assert bronze.count() == before + 1
    put(lake.paths["streaming_weather"], "w.csv", "time,temperature,apparentTemperature,humidity,pressure,windSpeed,windBearing,visibility,dewPoint,precipType,icon,summary\n2013-02-01 00:00:00,1.5,1,0.5,1000,2,3,4,5,rain,i,s\n")
    layers.run_weather_stream(spark, lake, once=True)
    assert layers.Run(spark, lake).load("bronze", "weather_hourly").filter("_source = 'weather_streaming'").count() == 1
    assert bronze.filter("household_id = 'H9'").first()["source_block"] == "9"
