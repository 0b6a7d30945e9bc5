from datetime import date

import pytest

from helpers import COLS, at, by, readings
from pyspark.sql import functions as F

from sievewatt.config import CheckSettings
from sievewatt.operators import checks, scoring

DAY = date(2024, 1, 1)


@pytest.fixture
def sample(spark):
    return readings(
        spark,
        [
            ("HH001", 0, 0.5),
            ("HH001", 30, 0.6),
            ("HH001", 60, 0.7),
            ("HH002", 0, 0.8),
            ("HH002", 30, None),
            ("HH003", 0, -0.5),
            ("HH003", 30, 100.0),
        ],
    )


def test_completeness_counts_rows_with_missing_values(sample):
    metrics, incidents = checks.completeness(sample, COLS)
    m = by(metrics, "household_id", "score_date")
    assert m["HH001", DAY]["actual_records"] == 3
    assert m["HH001", DAY]["expected_records"] == 48
    assert m["HH001", DAY]["missing_rate"] == pytest.approx(45 / 48)
    assert m["HH001", DAY]["completeness_error"] == 1
    assert m["HH002", DAY]["actual_records"] == 2
    i = by(incidents, "entity_id")
    assert len(i) == 3
    assert i["HH001",]["severity"] == "critical"
    assert i["HH001",]["evidence"] == "3|48|93.75"


def test_completeness_severity_is_warning_between_the_cuts(spark):
    df = readings(spark, [("A", 30 * i, 1.0) for i in range(40)])
    incidents = checks.completeness(df, COLS)[1].collect()
    assert [r["severity"] for r in incidents] == ["warning"]


def test_weekly_completeness_expects_seven_days(spark):
    df = readings(spark, [("A", 1440 * d + 30 * i, 1.0) for d in range(7) for i in range(48)])
    metrics, incidents = checks.completeness(df, COLS, grain="week")
    (row,) = metrics.collect()
    assert (row["score_date"], row["actual_records"], row["expected_records"]) == (DAY, 336, 336)
    assert incidents.count() == 0


def test_spine_adds_silent_days(spark):
    df = readings(spark, [("A", 0, 1.0), ("A", 3 * 1440, 1.0), ("B", 0, 1.0), ("B", None, 1.0)])
    m = by(checks.completeness(df, COLS, spine=True)[0], "household_id", "score_date")
    assert m["A", date(2024, 1, 2)]["actual_records"] == 0
    assert m["A", date(2024, 1, 2)]["missing_rate"] == 1.0
    assert ("B", None) in m
    assert len(m) == 6


def test_temporal_classes_are_exclusive_and_late_needs_arrival_order(spark):
    df = readings(spark, [("A", 0, 1.0), ("A", 30, 1.0), ("A", 30, 1.0), ("A", 120, 1.0), ("A", 90, 1.0)])
    metrics, incidents = checks.temporal(df, COLS)
    (m,) = metrics.collect()
    assert (m["gap_count"], m["duplicate_count"], m["out_of_order_count"]) == (1, 1, 1)
    assert m["anomalous_records"] == 2  # 90 is both a gap of 60 minutes and late
    assert m["anomaly_rate"] == pytest.approx(2 / 5)
    i = by(incidents, "rule_name")
    assert set(i) == {("temporal_gap",), ("temporal_duplicate",)}
    assert i["temporal_gap",]["incident_timestamp"] == at(90)
    every = checks.temporal(df, COLS, all_rules=True)[1]
    assert {r["rule_name"] for r in every.collect()} == {"temporal_gap", "temporal_duplicate", "temporal_out_of_order"}


def test_copies_of_a_reading_are_duplicates_however_many(spark):
    df = readings(spark, [("A", 0, 1.0), ("A", 30, 1.0)]).withColumn("arrival", F.lit(7).cast("long"))
    many = df.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(50)))).drop("n")
    (m,) = checks.temporal(many, COLS)[0].collect()
    assert (m["total_records"], m["duplicate_count"], m["gap_count"]) == (100, 98, 0)
    assert m["anomaly_rate"] == pytest.approx(0.98)


@pytest.mark.parametrize("rows_per_slice", [None, 2])
def test_a_batch_that_arrived_together_is_sorted_by_time(spark, rows_per_slice):
    rows = [("A", 60, 1.0), ("A", 0, 1.0), ("A", 30, 1.0), ("A", 90, 1.0), ("A", 75, 1.0), ("A", 120, 1.0)]
    df = readings(spark, rows).withColumn("arrival", F.when(F.col("arrival") < 4, 1).otherwise(2).cast("long"))
    m = checks.temporal(df, COLS, rows_per_slice=rows_per_slice)[0].first()
    # Only 75, the first of the second batch, came after a later reading (90).
    assert m["out_of_order_count"] == 1
    assert m["anomalous_records"] == 2  # 75 (late, and 15 minutes after 60) and 90 (15 minutes after 75)


def test_previous_reading_is_looked_up_across_midnight(spark):
    df = readings(spark, [("A", 1410, 1.0), ("A", 1440, 1.0), ("A", 2880 + 30, 1.0)])
    m = by(checks.temporal(df, COLS)[0], "score_date")
    assert m[date(2024, 1, 2),]["gap_count"] == 0
    assert m[date(2024, 1, 3),]["gap_count"] == 1


@pytest.mark.parametrize("rows_per_slice", [1, 3, 7, 1000])
def test_slicing_a_hot_entity_changes_nothing(spark, rows_per_slice):
    rows = [("hot", (i * 37) % 4000 + (i % 3), float(i % 7)) for i in range(300)] + [("cold", 60 * i, 1.0) for i in range(5)]
    rows += [(None, (i * 11) % 500, 1.0) for i in range(40)]
    df = readings(spark, rows)
    plain, cut = checks.temporal(df, COLS), checks.temporal(df, COLS, rows_per_slice=rows_per_slice)
    for a, b in zip(plain, cut):
        assert sorted(map(repr, a.select(sorted(a.columns)).collect())) == sorted(map(repr, b.select(sorted(b.columns)).collect()))


@pytest.mark.parametrize("rows_per_slice", [None, 1, 2, 50])
def test_missing_and_equal_arrivals_are_judged_alike_at_every_size(spark, rows_per_slice):
    data = [("a", 180, None), ("a", 180, 5), ("a", 480, 1), ("a", 540, 2), ("a", 540, 2), ("a", 300, 9), ("a", 300, 9), ("b", 60, None), ("b", 30, None)]
    rows = [(h, at(m), 1.0, i) for h, m, i in data]
    df = spark.createDataFrame(rows, "household_id string, timestamp timestamp, energy_kwh double, arrival bigint")
    metrics, incidents = checks.temporal(df, COLS, 60, 1, rows_per_slice=rows_per_slice)
    m = by(metrics, "household_id", "score_date")
    a, b = m["a", date(2024, 1, 1)], m["b", date(2024, 1, 1)]
    # 180 came after 540, but first without an arrival; 300 came after 540 once, its copy repeats it
    assert (a["total_records"], a["duplicate_count"], a["out_of_order_count"]) == (7, 3, 1)
    assert (b["out_of_order_count"], b["gap_count"]) == (0, 1)
    late = [r for r in incidents.collect() if r["rule_name"] == "temporal_out_of_order"]
    assert late == []
    assert a["anomalous_records"] == 3 + 2  # three repeats, and gaps before 300 and 480


def test_business_rules(sample):
    metrics, incidents = checks.business(sample, COLS, high=50.0)
    m = by(metrics, "household_id")
    assert (m["HH003",]["negative_count"], m["HH003",]["above_max_count"]) == (1, 1)
    assert m["HH002",]["violating_records"] == 0
    severity = {r["rule_name"]: r["severity"] for r in incidents.collect()}
    assert severity == {"business_negative_consumption": "critical", "business_above_max": "warning"}


def test_spikes_use_the_whole_history_and_ignore_missing_values(spark):
    rows = [("A", 30 * i, 1.0 + (i % 2) * 0.1) for i in range(60)] + [("A", 30 * 60, 30.0), ("A", 30 * 61, None), ("A", 30 * 62, float("nan"))]
    metrics, incidents = checks.business(readings(spark, rows), COLS)
    assert sum(r["extreme_spike_count"] for r in metrics.collect()) == 1
    (row,) = incidents.collect()
    assert (row["rule_name"], row["incident_timestamp"]) == ("business_extreme_spike", at(1800))


def test_constant_history_has_no_spikes(spark):
    df = readings(spark, [("A", 0, 5.0), ("A", 30, 5.0), ("B", 0, 9.0)])
    assert sum(r["extreme_spike_count"] for r in checks.business(df, COLS)[0].collect()) == 0


def test_entity_statistics_by_salted_join_match_the_broadcast_ones(spark):
    df = readings(spark, [("hot", 30 * i, float(i % 11)) for i in range(200)] + [("B", 0, 1.0), (None, 0, 2.0)])
    plain = checks.with_entity_stats(df, COLS)
    salted = checks.with_entity_stats(df.repartition(6), COLS, broadcast_bytes=-1, hot_rows=20)
    order = ["household_id", "timestamp"]
    a = [(r["household_id"], r["timestamp"], round(r["mean_value"], 9)) for r in plain.filter("household_id is not null").orderBy(order).collect()]
    b = [(r["household_id"], r["timestamp"], round(r["mean_value"], 9)) for r in salted.filter("household_id is not null").orderBy(order).collect()]
    assert a == b
    assert salted.count() == df.count()


def test_schema_validity(spark, sample):
    df = sample.withColumns({"tariff_type": F.when(F.col("energy_kwh") == 0.6, "Invalid").otherwise("STD "), "acorn_group": F.lit("Affluent")})
    metrics, incidents = checks.schema_validity(df, COLS, {"tariff_type": ["Std", "ToU"], "acorn_group": ["Affluent"]})
    m = by(metrics, "household_id")
    assert m["HH001",]["invalid_tariff_count"] == 1
    assert m["HH001",]["schema_validity_score"] == pytest.approx(2 / 3)
    assert m["HH002",]["out_of_range_count"] == 1  # a missing value is out of range
    assert m["HH003",]["out_of_range_count"] == 1  # -0.5; 100.0 is inside
    assert {r["rule_name"] for r in incidents.collect()} == {"schema_out_of_range", "schema_invalid_tariff"}


def test_schema_rules_skip_missing_columns_and_lists(sample):
    metrics = checks.schema_validity(sample, COLS, {"tariff_type": ["Std"], "household_id": []})[0]
    assert not [c for c in metrics.columns if c.startswith("invalid_") and c != "invalid_records"]


def test_rows_without_time_keep_a_day_of_their_own(spark):
    df = readings(spark, [("A", None, 1.0), ("A", None, 2.0), ("A", 0, 1.0)])
    m = by(checks.all_metrics(df, COLS, CheckSettings(enums={})), "household_id", "score_date")
    assert m["A", None]["actual_records"] == 2
    assert m["A", None]["null_timestamp_count"] == 2
    assert m["A", None]["total_records"] == 2
    s = by(scoring.quality_scores(df, COLS, CheckSettings(enums={})), "household_id", "score_date")
    assert s["A", None]["schema_score"] == 0.0


def test_one_row_breaking_several_rules_counts_once_in_the_rate(spark):
    df = readings(spark, [("A", 0, -5.0), ("A", 30, 1.0)])
    m = checks.all_metrics(df, COLS, CheckSettings(enums={})).first()
    assert m["violation_rate"] == 0.5
    assert m["schema_error_rate"] == 0.5


def test_fused_metrics_equal_the_separate_checks(sample):
    cfg = CheckSettings(enums={})
    fused = scoring.quality_scores(sample, COLS, cfg)
    apart = scoring.score(
        checks.completeness(sample, COLS)[0],
        checks.temporal(sample, COLS)[0],
        checks.business(sample, COLS)[0],
        checks.schema_validity(sample, COLS)[0],
        COLS.entity,
    )
    names = fused.columns
    assert sorted(map(repr, fused.collect())) == sorted(map(repr, apart.select(names).collect()))


def test_all_rules_explodes_every_hit(spark):
    df = readings(spark, [("A", 0, -5.0)] + [("A", 30 * i, 1.0) for i in range(1, 48)])
    default = checks.all_incidents(df, COLS, CheckSettings(enums={}, z_score=3.0))
    every = checks.all_incidents(df, COLS, CheckSettings(enums={}, z_score=3.0), all_rules=True)
    assert {r["rule_name"] for r in default.collect()} == {"business_negative_consumption", "schema_out_of_range"}
    assert {r["rule_name"] for r in every.collect()} == {
        "business_negative_consumption",
        "business_extreme_spike",
        "schema_out_of_range",
    }


def test_extra_readings_do_not_lift_a_score_above_one(spark):
    df = readings(spark, [("A", i, 1.0) for i in range(100)])
    row = scoring.quality_scores(df, COLS, CheckSettings(enums={})).first()
    assert row["completeness_score"] == 1.0
    assert 0 <= row["quality_score"] <= 100


def test_weather_consistency(spark):
    rows = [(f"H{e}", 1440 * d, float(d) if e == 0 else 5.0) for e in range(2) for d in range(20)]
    df = readings(spark, rows).withColumn("t", F.when(F.dayofmonth("timestamp") == 20, 100.0).otherwise(F.dayofmonth("timestamp").cast("double")))
    metrics, incidents = checks.weather_consistency(df, COLS, "t")
    assert by(metrics, "household_id")["H0",]["correlation"] > 0.5
    assert [(r["entity_id"], r["score_date"]) for r in incidents.collect()] == [("H1", date(2024, 1, 20))]
