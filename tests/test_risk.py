import random
from datetime import date, timedelta

import pytest
from helpers import by
from pyspark.sql import functions as F

from sievewatt.config import Cols, RiskSettings, Settings
from sievewatt.operators import expectations as E
from sievewatt.operators import features as ft
from sievewatt.operators.quantiles import median, quantiles, stratified_split
from sievewatt.plans import reports, training
from sievewatt.sources import sinks

COLS = Cols(("h",), "ts", "v", None)
D0 = date(2024, 1, 1)


def score_rows(spark, rows):
    """rows of (h, day offset, completeness, quality)."""
    data = [(h, D0 + timedelta(days=d), float(c), 1.0, 1.0, 1.0, float(q)) for h, d, c, q in rows]
    return spark.createDataFrame(
        data,
        "h string, score_date date, completeness_score double, temporal_score double, business_score double, schema_score double, quality_score double",
    )


def incident_rows(spark, rows):
    data = [(h, D0 + timedelta(days=d), "business_above_max", "warning") for h, d in rows]
    return spark.createDataFrame(data, "entity_id string, day date, rule_name string, severity string").withColumn(
        "incident_timestamp", F.col("day").cast("timestamp")
    )


def reading_rows(spark, rows):
    data = [(h, D0 + timedelta(days=d), float(v)) for h, d, v in rows]
    return spark.createDataFrame(data, "h string, d date, v double").select("h", F.col("d").cast("timestamp").alias("ts"), "v")


def test_windows_count_days_not_rows(spark):
    scores = score_rows(spark, [("A", d, 1 - d / 100, 90) for d in (0, 1, 2, 20)])
    out = by(ft.features(scores, incident_rows(spark, [("A", 0), ("A", 1)]), reading_rows(spark, [("A", 0, 1.0)]), COLS), "score_date")
    last = out[D0 + timedelta(days=20),]
    assert last["missing_rate_7d"] == pytest.approx(0.20)
    assert last["missing_rate_30d"] == pytest.approx((0 + 0.01 + 0.02 + 0.20) / 4)
    assert (last["incident_count_7d"], last["incident_count_30d"]) == (0, 2)


def test_the_future_does_not_change_features(spark):
    base = [("A", d, 0.9, 80) for d in range(10)]
    args = (incident_rows(spark, []), reading_rows(spark, [("A", d, d) for d in range(10)]), COLS)
    before = by(ft.features(score_rows(spark, base), *args), "score_date")
    after = by(ft.features(score_rows(spark, base[:-1] + [("A", 9, 0.1, 5)]), *args), "score_date")
    for d in range(9):
        assert before[D0 + timedelta(days=d),] == after[D0 + timedelta(days=d),]


def test_component_scores_of_the_day_are_no_features(spark):
    df = ft.features(score_rows(spark, [("A", 0, 1, 90)]), incident_rows(spark, []), reading_rows(spark, []), COLS).withColumn("target", F.lit(1))
    names = ft.feature_columns(df)
    assert not set(ft.SAME_DAY) & set(names)
    assert not [n for n in names if "quality_score" in n or "target" in n]
    assert "missing_rate_7d" in names and "avg_schema_score_30d" in names


def test_labels_look_one_day_ahead(spark):
    scores = score_rows(spark, [("A", 0, 1, 90), ("A", 1, 1, 60), ("A", 2, 1, 95), ("A", 4, 1, 10)])
    few = incident_rows(spark, [("A", 2)] * 5 + [("A", 1)])
    out = by(ft.labels(scores, few, ["h"]), "score_date")
    assert {k[0].day: (v["future_quality_score"], v["future_incident_count"], v["target"]) for k, v in out.items()} == {
        1: (60.0, 1, 1),
        2: (95.0, 5, 1),
    }
    loose = by(ft.labels(scores, incident_rows(spark, [("A", 2)]), ["h"]), "score_date")
    assert loose[date(2024, 1, 2),]["target"] == 0
    strict = by(ft.labels(scores, incident_rows(spark, [("A", 2)]), ["h"], any_incident=True), "score_date")
    assert strict[date(2024, 1, 2),]["target"] == 1
    with pytest.raises(ValueError, match="two different days"):
        ft.labels(scores.filter("day(score_date) = 1"), few, ["h"])


def test_holidays(spark):
    df = spark.createDataFrame([(D0,), (D0 + timedelta(days=1),)], "score_date date")
    listed = spark.createDataFrame([(D0,), (D0,), (None,)], "holiday_date date")
    assert sorted((r["score_date"], r["is_holiday"]) for r in ft.holiday_flag(df, listed).collect()) == [(D0, 1), (D0 + timedelta(days=1), 0)]


@pytest.mark.parametrize("values", [[5.0], [1.0, 2.0], [3.0, 1.0, 1.0, 99.5, 42.0, 42.0, None, 7.25]])
def test_quantiles_are_exact(spark, values):
    import numpy as np

    df = spark.createDataFrame([(v,) for v in values], "v double")
    known = [v for v in values if v is not None]
    got = {r["prob"]: r["value"] for r in quantiles(df, "v", [0.0, 0.25, 0.5, 0.9, 1.0], step=0.5).collect()}
    assert got == {p: pytest.approx(float(np.quantile(known, p))) for p in (0.0, 0.25, 0.5, 0.9, 1.0)}
    assert median(df.filter("false"), "v") is None


def test_split_is_exact_per_class_and_repeatable(spark):
    df = spark.range(1003).selectExpr("cast(id as string) as k", "cast(id % 10 = 0 as int) as target")
    counts = {}
    for _ in range(2):
        out = stratified_split(df.repartition(5), "target", ["k"], 0.8, 42)
        counts[_] = sorted((r["k"], r["is_train"]) for r in out.collect())
    assert counts[0] == counts[1]
    per = {(r["target"], r["is_train"]): r["count"] for r in out.groupBy("target", "is_train").count().collect()}
    assert per == {(0, 1): 721, (0, 0): 181, (1, 1): 80, (1, 0): 21}


def training_rows(spark, n=600):
    return spark.range(n).selectExpr(
        "cast(id as string) as entity_id",
        "date_add(date'2024-01-01', cast(id % 30 as int)) as score_date",
        "cast(id % 7 as double) as signal_7d",
        "if(id % 50 = 0, null, cast(id % 3 as double)) as noise_7d",
        "case when id % 2 = 0 then 'x' else 'y' end as segment",
        "cast(id % 7 > 4 as int) as target",
        "1.0D as quality_score",
    )


@pytest.mark.parametrize("kind", ["gbt", "logistic_regression"])
def test_train_evaluate_save_load_predict(spark, folder, kind):
    cfg = RiskSettings(model_type=kind, max_iter=5, min_instances=5)
    rows = training_rows(spark)
    train_rows, test_rows = training.split(rows, cfg)
    assert train_rows.count() + test_rows.count() == 600
    model, numbers = training.train(train_rows, cfg, ["segment"])
    assert numbers == ["signal_7d", "noise_7d"]
    found = training.evaluate(training.scored(model, test_rows, numbers))
    assert found["auc"] > 0.9
    gains = training.importances(model, numbers)
    assert max(gains, key=gains.get) == "signal_7d" and "segment" in gains
    assert training.model_versions(spark, folder) == []
    training.save_model(spark, model, numbers, found, folder, "v1")
    training.save_model(spark, model, numbers, found, folder, "v2")
    again, meta = training.load_model(spark, folder)
    assert meta["model_version"] == "v2" and training.model_versions(spark, folder) == ["v1", "v2"]
    out = training.predict(again, rows.drop("target", "noise_7d"), meta["features"], "v2", meta["importances"])
    assert {r["prediction_date"] for r in out.collect()} == {date(2024, 1, 31)}
    assert out.count() == 20 and len(out.first()["top_features"]) == 3
    assert {r["risk_category"] for r in out.collect()} <= {"low", "medium", "high"}


def test_training_needs_two_classes_and_evaluation_survives_one(spark):
    rows = training_rows(spark, 30).withColumn("target", F.lit(0))
    with pytest.raises(ValueError, match="both classes"):
        training.train(rows, RiskSettings())
    one = rows.withColumn("risk_score", F.lit(0.2))
    assert training.evaluate(one)["auc"] == 0.5


def test_expectations_in_one_pass(spark):
    df = spark.createDataFrame([("A", 1, 5.0), ("A", 1, None), (None, 2, 500.0)], "h string, t int, v double")
    suite = E.Suite((E.exists("h"), E.exists("nope"), E.not_null("h"), E.between("v", 0, 100), E.unique("h", "t"), E.of_type("v", "float64"), E.in_set("h", ["B"])))
    got = {(r["expectation"], r["column"]): (r["success"], r["unexpected_count"], r["total"]) for r in suite.validate(df).collect()}
    assert got == {
        ("column_exists", "h"): (True, None, 3),
        ("column_exists", "nope"): (False, None, 3),
        ("not_null", "h"): (False, 1, 3),
        ("between", "v"): (False, 1, 3),
        ("compound_unique", "h,t"): (False, 2, 3),
        ("of_type", "v"): (True, None, 3),
        ("in_set", "h"): (False, 2, 3),
    }
    assert len(E.readings_suite().expectations) == 8


def test_relative_dates_default_to_today(spark):
    df = spark.range(1).selectExpr("current_date() as d").union(spark.range(1).selectExpr("date_sub(current_date(), 8) as d"))
    assert df.filter(reports.recent("d", 7)).count() == 1


def test_settings_from_nested_config():
    raw = {
        "paths": {"smart_meters": {"household_info": "/h.csv"}, "gold_root": "/g"},
        "quality": {"business_rules": {"max_consumption": 9.0}, "schema": {"allowed_tariffs": ["Std"]}, "scoring": {"low_quality_threshold": 60.0}},
        "ml": {"quality_risk": {"model_type": "logistic_regression", "target_window_days": 2}},
        "streaming": {"max_files_per_trigger": 3},
    }
    s = Settings.from_dict(raw)
    assert s.paths == {"household_info": "/h.csv", "gold_root": "/g"}
    assert s.checks.max_value == 9.0 and s.checks.enums["tariff_type"] == ["Std"]
    assert s.scoring.low_quality_threshold == 60.0
    assert s.risk.model_type == "logistic_regression" and s.risk.horizon_days == 2
    assert s.max_files_per_trigger == 3


def test_ranking_matches_plain_pairs(spark):
    rng = random.Random(6)
    rows = [(rng.choice([0.0, 0.25, 0.5, rng.random()]), rng.random() < 0.3) for _ in range(400)]
    df = spark.createDataFrame([(s, int(t)) for s, t in rows] + [(None, 1), (0.5, None)], "risk_score double, target int").repartition(6)
    got = training.ranking(df).first()
    pos, neg = [s for s, t in rows if t], [s for s, t in rows if not t]
    auc = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
    share = [sum(t for s, t in rows if s >= p) / sum(s >= p for s, _ in rows) for p in pos]
    assert (got["positives"], got["negatives"]) == (len(pos), len(neg))
    assert abs(got["auc"] - auc) < 1e-12 and abs(got["average_precision"] - sum(share) / len(pos)) < 1e-12
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    judged = df.dropna().select(F.col("target").cast("double").alias("label"), F.col("risk_score").alias("rawPrediction"))
    assert abs(BinaryClassificationEvaluator().evaluate(judged) - auc) < 1e-9
    assert training.ranking(df.limit(0)).first().asDict() == {"positives": 0, "negatives": 0, "auc": 0.5, "average_precision": 0.0}


def test_reports_on_stored_predictions(spark, folder):
    """A second run of one day replaces it; the reports count what is stored then."""
    schema = "entity_id string, prediction_date date, risk_score double, risk_category string"

    def store(day, scores):
        rows = [(f"e{i}", D0 + timedelta(days=day), s, "low" if s < 0.3 else "medium" if s < 0.7 else "high") for i, s in enumerate(scores)]
        sinks.replace_parts(spark.createDataFrame(rows, schema), f"{folder}/predictions", ["prediction_date"])

    store(0, [0.1, 0.9])
    store(1, [0.9, 0.9, 0.9])
    store(1, [0.2, 0.5, 0.8, 1.0])
    stored = sinks.read_parts(spark, f"{folder}/predictions")
    assert by(reports.shares(stored, "risk_category"), "risk_category")["high",]["rows"] == 3
    bins = {r["bin"]: r["rows"] for r in reports.histogram(stored, "risk_score", 0.0, 1.0, bins=10).collect()}
    assert sum(bins.values()) == 6 and bins[9] == 2
    figures = reports.statistics(stored, "risk_score", step=0.001).first()
    assert figures["total"] == 6 and figures["median"] == pytest.approx(0.65) and figures["max"] == 1.0
    listed = reports.predictions_for(stored, F.lit(D0 + timedelta(days=1)), limit=3).collect()
    assert [r["entity_id"] for r in listed] == ["e3", "e2", "e1"]


def test_time_split_leaves_a_gap(spark):
    rows = [(f"e{i}", date(2024, 1, 1 + d), 0) for d in range(10) for i in range(3)] + [("e0", None, 1)]
    df = spark.createDataFrame(rows, "entity_id string, score_date date, target int")
    parts = {(r["score_date"].day if r["score_date"] else None): r["part"] for r in training.time_parts(df, 0.7, 2).collect()}
    assert parts == {None: None, **{d: "train" for d in range(1, 7)}, 7: "gap", **{d: "test" for d in range(8, 11)}}
    train_rows, test_rows = training.split_by_time(df, 0.7, 2)
    assert (train_rows.count(), test_rows.count()) == (18, 9)
    assert {r["part"] for r in training.time_parts(df.filter("score_date < '2024-01-02'"), 0.7).collect()} == {"train"}


def test_split_does_not_depend_on_buckets(spark):
    df = spark.range(500).select(F.col("id").alias("k"), (F.col("id") % 3 == 0).cast("int").alias("target"))
    one, many = ({r["k"] for r in stratified_split(df, "target", ["k"], 0.8, 42, n).filter("is_train = 1").collect()} for n in (10_000, 7))
    assert one == many and len(one) == int(167 * 0.8) + int(333 * 0.8)
