from datetime import date

import pytest
from helpers import COLS, at, by, readings, same_rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sievewatt.functions.columns import parse_number, parse_time, risk_category, score_category
from sievewatt.operators import clean, enrich, skew


def test_dedupe_keeps_the_first_arrival_of_every_entity_and_time(spark):
    df = readings(spark, [("A", 0, 2.0), ("A", 0, 1.0), ("A", 30, 3.0), ("B", 0, 4.0)])
    kept = clean.dedupe(df, ["household_id", "timestamp"], ["arrival"])
    assert sorted((r["household_id"], r["energy_kwh"]) for r in kept.collect()) == [("A", 2.0), ("A", 3.0), ("B", 4.0)]


def test_missing_values_pass_the_range_filter_and_are_imputed(spark):
    df = readings(spark, [("A", 0, 1.0), ("A", 30, None), ("A", 60, float("nan")), ("A", 90, 60.0), ("A", 120, -1.0), ("B", 0, None)])
    out = clean.clean_readings(df, COLS)
    assert by(out, "household_id", "timestamp").keys() == {("A", at(0)), ("A", at(30)), ("A", at(60))}
    assert {r["energy_kwh"] for r in out.collect()} == {1.0}
    row = out.first()
    assert (row["date"], row["day_of_week"], row["month"], row["_silver_processed"]) == (date(2024, 1, 1), 2, 1, True)


def test_trailing_mean_looks_back_48_rows_only(spark):
    df = readings(spark, [("A", 30 * i, 100.0 if i == 0 else 1.0) for i in range(49)] + [("A", 30 * 49, None)])
    out = by(clean.impute_trailing_mean(df, COLS), "timestamp")
    assert out[at(30 * 49),]["energy_kwh"] == 1.0


def test_forward_fill_has_an_age_limit(spark):
    df = readings(spark, [("A", 0, 1.0), ("A", 30, None), ("A", 300, None)])
    out = by(clean.forward_fill(df, COLS, max_age_minutes=60), "timestamp")
    assert out[at(30),]["energy_kwh"] == 1.0
    assert out[at(300),]["energy_kwh"] is None


@pytest.mark.parametrize("rows_per_slice", [1, 5, 40])
def test_imputation_is_the_same_when_hot_entities_are_cut(spark, rows_per_slice):
    rows = [("hot", 30 * i, None if i % 3 or i < 60 and i > 5 else float(i)) for i in range(200)] + [("cold", 0, 1.0), ("cold", 30, None)]
    df = readings(spark, rows)
    for fill in (clean.impute_trailing_mean, clean.forward_fill):
        plain, cut = fill(df, COLS), fill(df, COLS, rows_per_slice=rows_per_slice)
        key = lambda r: (r["household_id"], r["timestamp"], None if r["energy_kwh"] is None else round(r["energy_kwh"], 9))
        assert sorted(map(repr, map(key, plain.collect()))) == sorted(map(repr, map(key, cut.collect())))


@pytest.mark.parametrize("rows_per_slice", [None, 3, 1000])
@pytest.mark.parametrize("impute", ["trailing_mean", "forward_fill"])
def test_cleaning_is_the_same_with_hot_and_missing_entities(spark, rows_per_slice, impute):
    """Entities in one place or cut into slices: many copies, readings without entity or time."""
    rows = [("hot", m % 90 * 30, None if m % 4 == 0 else float(m % 7)) for m in range(300)]
    rows += [(None, m * 30, None if m % 2 else 1.0) for m in range(8)] + [("b", None, 2.0), ("b", None, 3.0), ("b", 0, None)]
    df = readings(spark, rows)
    plain = clean.dedupe(df, ["household_id", "timestamp"], ["arrival"])
    fill = clean.impute_trailing_mean if impute == "trailing_mean" else clean.forward_fill
    expected = fill(plain, COLS).filter("energy_kwh IS NOT NULL").select(*df.columns)
    same_rows(clean.clean_readings(df, COLS, impute=impute, rows_per_slice=rows_per_slice).select(*df.columns), expected)


def test_every_input_row_is_kept_or_rejected_with_a_reason(spark):
    rows = [("A", 0, 1.0), ("A", 0, 1.0), ("A", 30, -1.0), ("A", 60, 99.0), ("B", 0, None), ("B", 0, None), ("A", None, 2.0), ("A", None, 3.0)]
    df = readings(spark, rows)
    same = df.unionByName(df.filter("energy_kwh = 1.0"))
    kept, rejected = clean.split_rejected(same, COLS)
    reasons = {}
    for r in rejected.collect():
        reasons[r["reject_reason"]] = reasons.get(r["reject_reason"], 0) + r["row_count"]
    assert reasons == {"duplicate": 5, "below_min": 1, "above_max": 1, "not_imputable": 1}
    assert kept.count() + sum(reasons.values()) == same.count()


def test_missing_from_treats_null_times_as_equal(spark):
    df = readings(spark, [("A", 0, 1.0), ("A", None, 1.0), ("A", 30, 1.0)])
    lost = clean.missing_from(df, df.filter("timestamp is null or minute(timestamp) = 0"), ["household_id", "timestamp"])
    assert [r["timestamp"] for r in lost.collect()] == [at(30)]


def test_parsing_bad_text_gives_null(spark):
    df = spark.createDataFrame([("2012-10-12 00:30:00.0000000", " 0.25 "), ("x", "Null"), ("2012-10-12 00:30:00", "")], "t string, n string")
    rows = df.select(parse_time("t").alias("t"), parse_number("n").alias("n")).collect()
    assert rows[0]["t"].minute == 30 and rows[0]["n"] == 0.25
    assert rows[1]["t"] is None and rows[1]["n"] is None
    assert rows[2]["t"] == rows[0]["t"] and rows[2]["n"] is None


def test_categories_at_their_edges(spark):
    df = spark.createDataFrame([(90.0, 0.0), (89.99, 0.29), (80.0, 0.3), (70.0, 0.69), (69.99, 0.7)], "s double, r double")
    rows = df.select(score_category(F.col("s")).alias("s"), risk_category(F.col("r")).alias("r")).collect()
    assert [r["s"] for r in rows] == ["excellent", "good", "good", "fair", "poor"]
    assert [r["r"] for r in rows] == ["low", "low", "medium", "medium", "high"]


def test_enrichment_keeps_every_reading_once(spark):
    df = readings(spark, [("A", 10, 1.0), ("B", 70, 2.0)])
    dim = spark.createDataFrame([("A", " tou ", " X "), ("A", " tou ", " X ")], "household_id string, tariff_type string, acorn_group string")
    out = by(enrich.enrich_entities(df, dim, ["household_id"], ["tariff_type", "acorn_group"], upper=["tariff_type"]), "household_id")
    assert (out["A",]["tariff_type"], out["A",]["acorn_group"]) == ("TOU", "X")
    assert out["B",]["tariff_type"] is None
    weather = spark.createDataFrame([(at(5), 3.0), (at(0), 2.0)], "timestamp timestamp, temperature_celsius double")
    hourly = by(enrich.enrich_hourly(df, weather, "timestamp"), "household_id")
    assert hourly["A",]["temperature_celsius"] == 2.0
    assert hourly["B",]["temperature_celsius"] is None


def test_salted_join_equals_plain_join(spark):
    big = spark.range(3000).select(F.when(F.col("id") % 3 > 0, 1).when(F.col("id") % 50 == 0, None).otherwise(F.col("id")).alias("k"), "id").repartition(8)
    small = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("left", "inner"):
        plain = big.join(small, ["k"], how)
        salted = skew.salted_join(big, small, ["k"], how, hot_rows=100)
        assert sorted(map(repr, plain.collect())) == sorted(map(repr, salted.select(plain.columns).collect()))


def test_outer_merge_lines_up_null_keys(spark):
    a = spark.createDataFrame([("x", 1), (None, 2)], "k string, a int")
    b = spark.createDataFrame([(None, 3), ("y", 4)], "k string, b int")
    rows = {r["k"]: (r["a"], r["b"]) for r in skew.outer_merge([a, b], ["k"]).collect()}
    assert rows == {"x": (1, None), None: (2, 3), "y": (None, 4)}


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("AB"), st.integers(0, 20), st.sampled_from([None, -1.0, 1.0, 2.0, 99.0])), min_size=1, max_size=25))
def test_nothing_is_lost_on_random_input(spark, rows):
    df = readings(spark, [(h, 30 * m, v) for h, m, v in rows])
    kept, rejected = clean.split_rejected(df, COLS)
    dropped = rejected.agg(F.sum("row_count")).first()[0] or 0
    assert kept.count() + dropped == len(rows)
