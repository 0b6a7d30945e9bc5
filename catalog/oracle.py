"""The registered queries as SQL for DuckDB, put together from named parts."""

from __future__ import annotations

WINDOWS = (7, 30)

# name -> (parts it needs, SQL)
PARTS: dict[str, tuple[list[str], str]] = {}


def part(name: str, needs: str, sql: str) -> None:
    PARTS[name] = (needs.split(), sql)


def build(needs: str, sql: str, **other: str) -> str:
    """The query behind the parts it needs; ``other`` gives parts another SQL that needs no parts."""
    order: list[str] = []

    def visit(name: str) -> None:
        for dep in () if name in other else PARTS[name][0]:
            visit(dep)
        if name not in order:
            order.append(name)

    for name in needs.split():
        visit(name)
    if not order:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({other.get(n) or PARTS[n][1]})" for n in order) + "\n" + sql


# ---------------------------------------------------------------------- inputs

part(
    "dirty",
    "",
    """SELECT event_id, user_id,
       CASE WHEN event_id % 31 = 0 THEN NULL WHEN event_id % 37 = 0 THEN ts - INTERVAL 2 DAY ELSE ts END AS ts,
       CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 23 = 0 THEN -value ELSE value END AS value,
       CASE WHEN event_id % 41 = 0 THEN 'bogus' ELSE event_type END AS event_type,
       event_id * 2 + copy AS arrival
    FROM (SELECT *, unnest(CASE WHEN event_id % 29 = 0 THEN [0, 1] ELSE [0] END) AS copy FROM events)""",
)
part(
    "kept",
    "dirty",
    "SELECT * FROM dirty QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY arrival) = 1",
)
part("usable", "kept", "SELECT * FROM kept WHERE value IS NULL OR value BETWEEN 0 AND 100")
part(
    "filled",
    "usable",
    """SELECT * REPLACE (coalesce(value, avg(value) OVER (
           PARTITION BY user_id ORDER BY ts NULLS FIRST, arrival ROWS BETWEEN 48 PRECEDING AND CURRENT ROW)) AS value)
    FROM usable""",
)
part(
    "clean",
    "filled",
    """SELECT *, CAST(ts AS DATE) AS date, CAST(hour(ts) AS INTEGER) AS hour, CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week,
       CAST(day(ts) AS INTEGER) AS day_of_month, CAST(month(ts) AS INTEGER) AS month, CAST(year(ts) AS INTEGER) AS year,
       value > 0 AS _silver_processed
    FROM filled WHERE value IS NOT NULL""",
)
part(
    "weather",
    "",
    """SELECT date_trunc('hour', ts) AS hour_at,
       avg(value) FILTER (WHERE event_type = 'view') AS temperature_celsius,
       avg(value) FILTER (WHERE event_type = 'click') / 499 AS humidity_ratio,
       max(event_type) AS weather_summary
    FROM events GROUP BY 1""",
)
part(
    "households",
    "",
    """SELECT c_custkey AS user_id, CASE WHEN c_acctbal < 0 THEN 'TOU' ELSE 'STD' END AS tariff_type,
       'ACORN-' || c_mktsegment[1] AS acorn_code, c_mktsegment AS acorn_group FROM customer""",
)
part(
    "weathered",
    "clean weather",
    """SELECT c.*, temperature_celsius, humidity_ratio, weather_summary
    FROM clean c LEFT JOIN weather w ON date_trunc('hour', c.ts) = w.hour_at""",
)
part(
    "holidays",
    "",
    "SELECT DISTINCT CAST(ts AS DATE) AS holiday_date FROM events WHERE dayofweek(ts) = 0",
)

# ---------------------------------------------------------------------- checks

part(
    "daily",
    "dirty",
    """SELECT user_id, CAST(ts AS DATE) AS score_date, count(*) AS actual_records, count(ts) AS non_null_records,
       min(ts) AS min_timestamp, max(ts) AS max_timestamp FROM dirty GROUP BY 1, 2""",
)
part(
    "flags",
    "dirty",
    """SELECT *, CASE WHEN ts <> prev_ts AND abs(date_diff('microsecond', prev_ts, ts) / 60000000.0 - 480) > 240 THEN 1 ELSE 0 END AS is_gap,
       CASE WHEN ts = prev_ts THEN 1 ELSE 0 END AS is_dup, CASE WHEN ts < before THEN 1 ELSE 0 END AS is_late
    FROM (SELECT user_id, ts, arrival,
            lag(ts) OVER (PARTITION BY user_id ORDER BY ts, arrival) AS prev_ts,
            lag(ts) OVER (PARTITION BY user_id ORDER BY arrival, ts) AS before
          FROM dirty WHERE ts IS NOT NULL)""",
)
part(
    "cadence",
    "flags dirty",
    """SELECT user_id, score_date, CAST(sum(n) AS BIGINT) AS total_records, CAST(sum(is_gap) AS BIGINT) AS gap_count,
       CAST(sum(is_dup) AS BIGINT) AS duplicate_count, CAST(sum(is_late) AS BIGINT) AS out_of_order_count,
       CAST(sum(greatest(is_gap, is_dup, is_late)) AS BIGINT) AS anomalous_records
    FROM (SELECT user_id, CAST(ts AS DATE) AS score_date, 1 AS n, is_gap, is_dup, is_late FROM flags
          UNION ALL SELECT user_id, NULL, 1, 0, 0, 0 FROM dirty WHERE ts IS NULL)
    GROUP BY 1, 2""",
)
part(
    "entity_stats",
    "dirty",
    "SELECT user_id, avg(value) AS mean_value, stddev_samp(value) AS std_value FROM dirty GROUP BY 1",
)
part(
    "judged_rows",
    "dirty entity_stats",
    """SELECT d.*, mean_value, std_value, coalesce(value < 0, false) AS neg, coalesce(value > 100, false) AS over,
       coalesce(std_value > 0 AND abs((value - mean_value) / std_value) > 3, false) AS spike,
       d.ts IS NULL AS no_ts, coalesce(NOT value BETWEEN 0 AND 400, true) AS out_range,
       event_type NOT IN ('view', 'click', 'signup', 'purchase', 'error') AS bad_type
    FROM dirty d JOIN entity_stats s ON d.user_id = s.user_id""",
)
part(
    "row_metrics",
    "judged_rows",
    """SELECT user_id, CAST(ts AS DATE) AS score_date, count(*) AS total_records,
       count(*) FILTER (neg) AS negative_count, count(*) FILTER (over) AS above_max_count,
       count(*) FILTER (spike) AS extreme_spike_count, count(*) FILTER (neg OR over OR spike) AS violating_records,
       count(*) FILTER (no_ts) AS null_timestamp_count, count(*) FILTER (out_range) AS out_of_range_count,
       count(*) FILTER (bad_type) AS invalid_event_type_count, count(*) FILTER (no_ts OR out_range OR bad_type) AS invalid_records
    FROM judged_rows GROUP BY 1, 2""",
)
part(
    "components",
    "row_metrics cadence",
    """SELECT m.user_id, m.score_date,
       least(greatest(1 - (1 - m.total_records / 3.0::DOUBLE), 0), 1) AS completeness_score,
       1 - anomalous_records / c.total_records AS temporal_score,
       1 - violating_records / m.total_records AS business_score,
       1 - invalid_records / m.total_records AS schema_score
    FROM row_metrics m JOIN cadence c ON m.user_id = c.user_id AND m.score_date IS NOT DISTINCT FROM c.score_date""",
)
part(
    "scores",
    "components",
    """SELECT *, CASE WHEN quality_score >= 90 THEN 'excellent' WHEN quality_score >= 80 THEN 'good'
         WHEN quality_score >= 70 THEN 'fair' ELSE 'poor' END AS quality_category,
       CASE WHEN quality_score < 70 THEN 1 ELSE 0 END AS is_low_quality
    FROM (SELECT *, (0.40::DOUBLE * completeness_score + 0.25::DOUBLE * temporal_score + 0.20::DOUBLE * business_score
         + 0.15::DOUBLE * schema_score) * 100 AS quality_score FROM components)""",
)


def _incidents(every: bool) -> str:
    """One row per broken rule; by default only under the first rule of a family."""
    one = "" if every else "AND NOT ({})"

    def unless(cond: str) -> str:
        return one.format(cond) if one else ""

    rows = "SELECT user_id, ts AS incident_timestamp, CAST(ts AS DATE) AS score_date"
    number = "round({}, 8)::DOUBLE::VARCHAR".format
    minutes = number("date_diff('microsecond', prev_ts, ts) / 60000000::DOUBLE")
    z = number("(value - mean_value) / std_value")
    families = [
        f"{rows}, 'temporal_gap', 'warning', {minutes} || '||' FROM flags WHERE is_gap = 1",
        f"{rows}, 'temporal_duplicate', 'warning', '|duplicate|' FROM flags WHERE is_dup = 1",
        f"{rows}, 'temporal_out_of_order', 'warning', '||out_of_order' FROM flags WHERE is_late = 1 {unless('is_gap = 1 OR is_dup = 1')}",
        f"{rows}, 'business_negative_consumption', 'critical', {number('value')} || '||' FROM judged_rows WHERE neg",
        f"{rows}, 'business_above_max', 'warning', '|' || {number('value')} || '|' FROM judged_rows WHERE over {unless('neg')}",
        f"{rows}, 'business_extreme_spike', 'warning', '||' || {z} FROM judged_rows WHERE spike {unless('neg OR over')}",
        f"{rows}, 'schema_null_timestamp', 'warning', 'schema_violation' FROM judged_rows WHERE no_ts",
        f"{rows}, 'schema_out_of_range', 'warning', 'schema_violation' FROM judged_rows WHERE out_range {unless('no_ts')}",
        f"{rows}, 'schema_invalid_event_type', 'warning', 'schema_violation' FROM judged_rows WHERE bad_type {unless('no_ts OR out_range')}",
    ]
    day = f"""SELECT user_id, CAST(score_date AS TIMESTAMP) AS incident_timestamp, score_date, 'completeness_high_missing_rate' AS rule_name,
       CASE WHEN 1 - actual_records / 3.0::DOUBLE > 0.25 THEN 'critical' ELSE 'warning' END AS severity,
       {number('actual_records')} || '|3.0|' || {number('(1 - actual_records / 3.0::DOUBLE) * 100')} AS evidence
    FROM daily WHERE 1 - actual_records / 3.0::DOUBLE > 0.10"""
    union = " UNION ALL ".join([day, *families])
    return f"""SELECT CAST(user_id AS VARCHAR) AS entity_id, score_date, incident_timestamp, rule_name, severity, min(evidence) AS evidence
    FROM ({union}) GROUP BY ALL"""


part("incidents", "daily flags judged_rows", _incidents(False))
part("incidents_every", "daily flags judged_rows", _incidents(True))

# -------------------------------------------------------------- features, labels

part(
    "incident_counts",
    "incidents",
    """SELECT entity_id, CAST(incident_timestamp AS DATE) AS score_date, count(*) AS total_incidents,
       count(*) FILTER (rule_name LIKE '%completeness%') AS completeness_incidents,
       count(*) FILTER (rule_name LIKE '%temporal%') AS temporal_incidents,
       count(*) FILTER (rule_name LIKE '%business%') AS business_incidents,
       count(*) FILTER (rule_name LIKE '%schema%') AS schema_incidents,
       count(*) FILTER (severity = 'critical') AS critical_incidents,
       count(*) FILTER (severity = 'warning') AS warning_incidents
    FROM incidents WHERE incident_timestamp IS NOT NULL GROUP BY 1, 2""",
)
part(
    "consumption",
    "weathered",
    """SELECT CAST(user_id AS VARCHAR) AS entity_id, CAST(ts AS DATE) AS score_date, count(*) AS reading_count,
       avg(value) AS avg_consumption, stddev_samp(value) AS std_consumption, min(value) AS min_consumption, max(value) AS max_consumption,
       avg(temperature_celsius) AS avg_temperature, min(temperature_celsius) AS min_temperature,
       max(temperature_celsius) AS max_temperature, avg(humidity_ratio) AS avg_humidity,
       CASE WHEN avg(value) > 0 THEN stddev_samp(value) / avg(value) ELSE 0 END AS consumption_cv
    FROM weathered WHERE ts IS NOT NULL GROUP BY 1, 2""",
)
part("keyed", "scores", "SELECT CAST(user_id AS VARCHAR) AS entity_id, * FROM scores WHERE score_date IS NOT NULL")
part(
    "feature_base",
    "keyed incident_counts consumption",
    """SELECT entity_id, score_date, coalesce(1 - completeness_score, 0) AS missing_rate,
       completeness_score AS _completeness, temporal_score AS _temporal, business_score AS _business, schema_score AS _schema,
       """
    + ", ".join(
        f"coalesce({c}, 0) AS {c}"
        for c in (
            "total_incidents completeness_incidents temporal_incidents business_incidents schema_incidents critical_incidents "
            "warning_incidents reading_count avg_consumption std_consumption consumption_cv"
        ).split()
    )
    + """, min_consumption, max_consumption, avg_temperature, min_temperature, max_temperature, avg_humidity,
       CAST(dayofweek(score_date) + 1 AS INTEGER) AS day_of_week, CAST(month(score_date) AS INTEGER) AS month
    FROM (SELECT entity_id, score_date FROM keyed UNION SELECT entity_id, score_date FROM incident_counts
          UNION SELECT entity_id, score_date FROM consumption)
    LEFT JOIN keyed USING (entity_id, score_date) LEFT JOIN incident_counts USING (entity_id, score_date)
    LEFT JOIN consumption USING (entity_id, score_date)""",
)


def _rolled(ago: int = 0) -> list[tuple[str, str]]:
    """(name, SQL) of the trailing features; ``ago=1`` leaves the current day out."""
    out = []
    for w in WINDOWS:
        frame = (
            f"OVER (PARTITION BY entity_id ORDER BY score_date RANGE BETWEEN INTERVAL {w - 1 + ago} DAYS PRECEDING AND "
            + (f"INTERVAL {ago} DAYS PRECEDING)" if ago else "CURRENT ROW)")
        )
        out.append((f"missing_rate_{w}d", f"avg(missing_rate) {frame}"))
        out.append((f"incident_count_{w}d", f"CAST(sum(total_incidents) {frame} AS BIGINT)"))
        for c in ("completeness", "temporal", "business", "schema"):
            out.append((f"avg_{c}_score_{w}d", f"avg(_{c}) {frame}"))
        out.append((f"std_consumption_{w}d", f"avg(std_consumption) {frame}"))
        out.append((f"avg_consumption_{w}d", f"avg(avg_consumption) {frame}"))
        out.append((f"consumption_trend_{w}d", f"avg_consumption - avg(avg_consumption) {frame}"))
        for c in ("critical", "completeness", "temporal", "business"):
            out.append((f"{c}_incidents_{w}d", f"CAST(sum({c}_incidents) {frame} AS BIGINT)"))
        for c, f in (("avg_temperature", "avg"), ("min_temperature", "min"), ("max_temperature", "max"), ("avg_humidity", "avg")):
            out.append((f"{c}_{w}d", f"{f}({c}) {frame}"))
    return out


_COUNTS = (
    "total_incidents completeness_incidents temporal_incidents business_incidents schema_incidents critical_incidents "
    "warning_incidents reading_count day_of_week month"
).split()
_PLAIN = (
    "missing_rate avg_consumption std_consumption consumption_cv min_consumption max_consumption avg_temperature "
    "min_temperature max_temperature avg_humidity"
).split()


def _feature_sql(ago: int) -> str:
    rolled = [
        f"{sql} AS {name}" if name.startswith("incident_count") or "_incidents_" in name else f"round({sql}, 9) AS {name}"
        for name, sql in _rolled(ago)
    ]
    columns = ["entity_id", "score_date", *_COUNTS, *[f"round({c}, 9) AS {c}" for c in _PLAIN], *rolled]
    return f"""SELECT {", ".join("f." + c if c in ("entity_id", "score_date") else c for c in columns)},
       tariff_type, acorn_group, CASE WHEN holiday_date IS NULL THEN 0 ELSE 1 END AS is_holiday
    FROM feature_base f LEFT JOIN households h ON f.entity_id = CAST(h.user_id AS VARCHAR)
    LEFT JOIN holidays ON f.score_date = holiday_date"""


part("feature_rows", "feature_base households holidays", _feature_sql(0))
part("feature_rows_before", "feature_base households holidays", _feature_sql(1))
part(
    "labels",
    "keyed incident_counts",
    """SELECT k.entity_id, k.score_date, f.quality_score AS future_quality_score, coalesce(i.total_incidents, 0) AS future_incident_count,
       CASE WHEN f.quality_score < 70 OR coalesce(i.total_incidents, 0) >= 5 THEN 1 ELSE 0 END AS target
    FROM keyed k JOIN keyed f ON k.entity_id = f.entity_id AND k.score_date = f.score_date - 1
    LEFT JOIN incident_counts i ON k.entity_id = i.entity_id AND k.score_date = i.score_date - 1""",
)
part(
    "baseline",
    "keyed",
    """SELECT *, CASE WHEN risk_score < 0.3 THEN 'low' WHEN risk_score < 0.7 THEN 'medium' ELSE 'high' END AS risk_category
    FROM (SELECT entity_id, score_date + 1 AS prediction_date, 1 - quality_score / 100 AS risk_score FROM keyed)""",
)
part(
    "judged",
    "keyed labels",
    """SELECT entity_id, score_date, 1 - quality_score / 100 AS risk_score, target
    FROM keyed JOIN labels USING (entity_id, score_date)""",
)

# ------------------------------------------------------------------ whole runs

# The lake holds seconds, and all readings of a run arrive at one time.
part(
    "lake_copies",
    "dirty",
    """SELECT *, count(*) AS n, row_number() OVER (PARTITION BY user_id, ts ORDER BY value NULLS FIRST, block) AS place
    FROM (SELECT user_id, date_trunc('second', ts) AS ts, value, CAST(event_id // 1000 AS VARCHAR) AS block FROM dirty)
    GROUP BY user_id, ts, value, block""",
)
part(
    "lake_filled",
    "lake_copies",
    """SELECT user_id, ts, coalesce(value, avg(value) OVER (
           PARTITION BY user_id ORDER BY ts NULLS FIRST ROWS BETWEEN 48 PRECEDING AND CURRENT ROW)) AS value
    FROM lake_copies WHERE place = 1 AND (value IS NULL OR value BETWEEN 0 AND 100)""",
)
part("lake_clean", "lake_filled", "SELECT * FROM lake_filled WHERE value IS NOT NULL")

_LAKE_SOURCES = {
    "bronze/household_info": "customer",
    "bronze/acorn_details": "part",
    "bronze/halfhourly_consumption": "dirty",
    "bronze/weather_hourly": "(SELECT DISTINCT date_trunc('hour', ts) FROM events)",
    "bronze/weather_daily": "(SELECT DISTINCT CAST(ts AS DATE) FROM events)",
    "bronze/daily_consumption": "(SELECT DISTINCT user_id, CAST(ts AS DATE) FROM events)",
    "bronze/bank_holidays": "holidays",
    "bronze/gadm_level3": "nation",
    "bronze/osm_buildings": "part",
}
_LAKE_MADE = {
    "silver/halfhourly_consumption": "lake_clean",
    "silver/rejected_readings": """(SELECT 1 FROM lake_copies WHERE n > 1 OR place > 1
        UNION ALL SELECT 1 FROM lake_copies WHERE place = 1 AND NOT value BETWEEN 0 AND 100
        UNION ALL SELECT 1 FROM lake_filled WHERE value IS NULL)""",
    "silver/household_enriched": "lake_clean",
    "silver/weather_enriched": "lake_clean",
    "gold/quality_scores": "(SELECT DISTINCT user_id, CAST(ts AS DATE) FROM lake_clean)",
    "gold/quality_incidents": "("
    + build("incidents", "SELECT * FROM incidents", dirty="SELECT 0 AS event_id, *, 'view' AS event_type, 0 AS arrival FROM lake_clean")
    + ")",
    "gold/weekly_completeness_incidents": """(SELECT 1 FROM lake_clean
        GROUP BY user_id, date_trunc('week', ts) HAVING 1 - count(*) / 21.0::DOUBLE > 0.25)""",
    "gold/consumption_analytics": "(SELECT DISTINCT user_id, CAST(ts AS DATE) FROM lake_clean)",
    "gold/gadm_level3": "nation",
    "gold/osm_buildings": "part",
    "gold/building_aggregations": "nation",
}


def _table_rows(listed: dict[str, str]) -> str:
    return " UNION ALL ".join(f"""SELECT '{name}' AS "table", count(*) AS rows FROM {sql}""" for name, sql in listed.items())


part("lake_rows", "dirty holidays lake_copies lake_filled lake_clean", _table_rows(_LAKE_SOURCES | _LAKE_MADE))
# What each table of the lake is made of.
_LAKE_EDGES = {
    "bronze/household_info": "households",
    "bronze/acorn_details": "segments",
    "bronze/halfhourly_consumption": "halfhourly",
    "bronze/weather_hourly": "weather-hourly",
    "bronze/weather_daily": "weather-daily",
    "bronze/daily_consumption": "daily",
    "bronze/bank_holidays": "holidays",
    "bronze/gadm_level3": "areas",
    "bronze/osm_buildings": "osm",
    "silver/halfhourly_consumption": "bronze/halfhourly_consumption",
    "silver/rejected_readings": "bronze/halfhourly_consumption",
    "silver/household_enriched": "silver/halfhourly_consumption bronze/household_info",
    "silver/weather_enriched": "silver/halfhourly_consumption bronze/weather_hourly",
    "gold/quality_scores": "silver/household_enriched",
    "gold/quality_incidents": "silver/household_enriched",
    "gold/weekly_completeness_incidents": "silver/household_enriched",
    "gold/consumption_analytics": "silver/household_enriched bronze/weather_hourly",
    "gold/gadm_level3": "bronze/gadm_level3",
    "gold/osm_buildings": "bronze/osm_buildings",
    "gold/building_aggregations": "gold/osm_buildings gold/gadm_level3",
}
# The second run of the audited lake has no readings and ends with the sources.
_LAKE_AGAIN = [t for t in _LAKE_SOURCES if t != "bronze/halfhourly_consumption"]

# --------------------------------------------------------------------- queries


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}

    def add(name: str, needs: str, sql: str) -> None:
        q[name] = build(needs, sql)

    # silver
    add(
        "clean_readings",
        "clean",
        """SELECT user_id, ts, round(value, 9) AS value, event_type, date, hour, day_of_week, day_of_month, month, year,
           _silver_processed FROM clean""",
    )
    add(
        "forward_fill",
        "usable",
        """SELECT user_id, ts, arrival, coalesce(value, CASE WHEN date_diff('microsecond', seen_at, ts) <= 4320 * 60000000::BIGINT THEN v END) AS value
        FROM (SELECT *, last_value(value IGNORE NULLS) OVER w AS v,
                last_value(CASE WHEN value IS NOT NULL THEN ts END IGNORE NULLS) OVER w AS seen_at FROM usable
              WINDOW w AS (PARTITION BY user_id ORDER BY ts NULLS FIRST, arrival ROWS UNBOUNDED PRECEDING))""",
    )
    add(
        "rejected_rows",
        "dirty kept filled",
        """SELECT event_id, user_id, ts, value, event_type, arrival, reject_reason, 1::BIGINT AS row_count FROM (
          SELECT *, 'duplicate' AS reject_reason FROM dirty WHERE arrival NOT IN (SELECT arrival FROM kept)
          UNION ALL SELECT *, CASE WHEN value < 0 THEN 'below_min' ELSE 'above_max' END FROM kept WHERE value < 0 OR value > 100
          UNION ALL SELECT *, 'not_imputable' FROM filled WHERE value IS NULL)""",
    )
    add(
        "missing_from_silver",
        "dirty clean",
        """SELECT event_id, user_id, ts, arrival FROM dirty d WHERE NOT EXISTS (
          SELECT 1 FROM clean c WHERE c.user_id = d.user_id AND c.ts IS NOT DISTINCT FROM d.ts)""",
    )
    add(
        "enriched_readings",
        "dirty households",
        """SELECT d.event_id, d.arrival, d.user_id, tariff_type, acorn_code, acorn_group
        FROM dirty d LEFT JOIN households h ON d.user_id = h.user_id""",
    )
    add(
        "weather_enriched",
        "weathered",
        """SELECT user_id, ts, round(value, 9) AS value, round(temperature_celsius, 9) AS temperature_celsius,
           round(humidity_ratio, 9) AS humidity_ratio, weather_summary FROM weathered""",
    )
    analytics = """SELECT w.user_id, date, acorn_group, tariff_type, year, month, day_of_week, count(*) AS halfhourly_readings_count,
           round(avg(value), 9) AS avg_consumption_kwh, round(sum(value), 9) AS total_daily_consumption_kwh,
           round(min(value), 9) AS min_consumption_kwh, round(max(value), 9) AS max_consumption_kwh,
           round(stddev_samp(value), 9) AS std_consumption_kwh, round(avg(temperature_celsius), 9) AS avg_temperature_celsius,
           round(min(temperature_celsius), 9) AS min_temperature_celsius, round(max(temperature_celsius), 9) AS max_temperature_celsius,
           round(avg(humidity_ratio), 9) AS avg_humidity_ratio, round(sum(value) / count(*), 9) AS consumption_per_reading
        FROM weathered w LEFT JOIN households h ON w.user_id = h.user_id GROUP BY ALL"""
    add("consumption_analytics", "weathered households", analytics)
    add(
        "joined_enriched",
        "weathered households",
        """SELECT w.user_id, ts, round(value, 9) AS value, acorn_group, round(temperature_celsius, 9) AS temperature_celsius
        FROM weathered w LEFT JOIN households h ON w.user_id = h.user_id""",
    )

    # checks
    def complete(source: str, days: int, threshold: float) -> str:
        n = f"{3 * days}.0::DOUBLE"
        return f"""SELECT user_id, score_date, actual_records, non_null_records, min_timestamp, max_timestamp,
           {3 * days}::BIGINT AS expected_records, {3 * days} - actual_records AS missing_records,
           round(actual_records / {n}, 9) AS completeness_rate, round(1 - actual_records / {n}, 9) AS missing_rate,
           CASE WHEN 1 - actual_records / {n} > {threshold} THEN 1 ELSE 0 END AS completeness_error FROM {source}"""

    add("completeness_daily", "daily", complete("daily", 1, 0.10))
    add(
        "completeness_weekly",
        "daily",
        complete(
            """(SELECT user_id, CAST(date_trunc('week', score_date) AS DATE) AS score_date, CAST(sum(actual_records) AS BIGINT) AS actual_records,
               CAST(sum(non_null_records) AS BIGINT) AS non_null_records, min(min_timestamp) AS min_timestamp,
               max(max_timestamp) AS max_timestamp FROM daily GROUP BY 1, 2)""",
            7,
            0.25,
        ),
    )
    add(
        "completeness_spine",
        "daily",
        complete(
            """(SELECT user_id, score_date, coalesce(actual_records, 0) AS actual_records, coalesce(non_null_records, 0) AS non_null_records,
                 min_timestamp, max_timestamp
               FROM (SELECT user_id, CAST(unnest(generate_series(min(score_date), max(score_date), INTERVAL 1 DAY)) AS DATE) AS score_date
                     FROM daily GROUP BY 1) LEFT JOIN daily USING (user_id, score_date)
               UNION ALL SELECT * FROM daily WHERE score_date IS NULL)""",
            1,
            0.10,
        ),
    )
    add(
        "temporal_metrics",
        "cadence",
        """SELECT *, gap_count + duplicate_count + out_of_order_count AS total_anomalies,
           round(anomalous_records / total_records, 9) AS anomaly_rate,
           CASE WHEN anomalous_records / total_records > 0.05 THEN 1 ELSE 0 END AS temporal_coherence_error FROM cadence""",
    )
    add(
        "business_metrics",
        "row_metrics",
        """SELECT user_id, score_date, total_records, negative_count, above_max_count, extreme_spike_count, violating_records,
           negative_count + above_max_count + extreme_spike_count AS total_violations,
           round(violating_records / total_records, 9) AS violation_rate,
           CASE WHEN violating_records / total_records > 0.01 THEN 1 ELSE 0 END AS business_rule_error FROM row_metrics""",
    )
    add(
        "schema_metrics",
        "row_metrics",
        """SELECT user_id, score_date, total_records, null_timestamp_count, out_of_range_count, invalid_event_type_count, invalid_records,
           null_timestamp_count + out_of_range_count + invalid_event_type_count AS total_schema_errors,
           round(invalid_records / total_records, 9) AS schema_error_rate,
           round(1 - invalid_records / total_records, 9) AS schema_validity_score FROM row_metrics""",
    )
    add("incidents_all", "incidents", "SELECT * FROM incidents")
    add("incidents_every_rule", "incidents_every", "SELECT * FROM incidents_every")
    add(
        "weather_correlation",
        "weathered",
        """SELECT user_id, CAST(date_trunc('month', ts) AS DATE) AS month, count(*) FILTER (temperature_celsius IS NOT NULL) AS pair_count,
           round(CASE WHEN count(*) FILTER (temperature_celsius IS NOT NULL) >= 3 THEN corr(value, temperature_celsius) END, 9) AS correlation
        FROM weathered WHERE ts IS NOT NULL GROUP BY 1, 2""",
    )
    add(
        "weather_mismatches",
        "weathered",
        """SELECT CAST(user_id AS VARCHAR) AS entity_id, score_date, 'business_weather_mismatch' AS rule_name FROM (
          SELECT *, (w - avg(w) OVER m) / nullif(stddev_samp(w) OVER m, 0) AS wz, (v - avg(v) OVER m) / nullif(stddev_samp(v) OVER m, 0) AS vz
          FROM (SELECT user_id, CAST(ts AS DATE) AS score_date, date_trunc('month', ts) AS mon, avg(value) AS v, avg(temperature_celsius) AS w
                FROM weathered WHERE ts IS NOT NULL GROUP BY 1, 2, 3)
          WINDOW m AS (PARTITION BY user_id, mon))
        WHERE abs(wz) > 2 AND coalesce(abs(vz), 0) < 0.5""",
    )
    add(
        "expectations",
        "dirty",
        """WITH t AS (SELECT count(*) AS total FROM dirty),
        r(expectation, "column", bad) AS (
          SELECT 'column_exists', 'user_id', NULL UNION ALL SELECT 'column_exists', 'ts', NULL UNION ALL SELECT 'column_exists', 'value', NULL
          UNION ALL SELECT 'not_null', 'user_id', count(*) FILTER (user_id IS NULL) FROM dirty
          UNION ALL SELECT 'not_null', 'ts', count(*) FILTER (ts IS NULL) FROM dirty
          UNION ALL SELECT 'between', 'value', count(*) FILTER (NOT value BETWEEN 0 AND 400) FROM dirty
          UNION ALL SELECT 'compound_unique', 'user_id,ts', sum(n) FROM (SELECT count(*) AS n FROM dirty GROUP BY user_id, ts HAVING n > 1)
          UNION ALL SELECT 'of_type', 'value', NULL
          UNION ALL SELECT 'in_set', 'event_type',
            count(*) FILTER (event_type NOT IN ('view', 'click', 'signup', 'purchase', 'error')) FROM dirty)
        SELECT expectation, "column", coalesce(bad = 0, true) AS success, CAST(bad AS BIGINT) AS unexpected_count, total FROM r, t""".replace(
            "WITH t AS", "SELECT * FROM (WITH t AS", 1
        )
        + ")",
    )

    # scores
    s6 = ", ".join(f"round({c}, 9) AS {c}" for c in ("completeness_score", "temporal_score", "business_score", "schema_score", "quality_score"))
    add("quality_scores", "scores", f"SELECT user_id, score_date, {s6}, quality_category, is_low_quality FROM scores")
    add("scores_from_four_checks", "scores", f"SELECT user_id, score_date, {s6}, quality_category, is_low_quality FROM scores")
    add(
        "score_rollup",
        "scores households",
        """SELECT acorn_group, CAST(date_trunc('week', score_date) AS DATE) AS week_window, round(avg(quality_score), 9) AS avg_quality_score,
           count(*) AS household_count, CAST(sum(is_low_quality) AS BIGINT) AS low_quality_count,
           round(avg(completeness_score), 9) AS avg_completeness, round(avg(temporal_score), 9) AS avg_temporal,
           round(avg(business_score), 9) AS avg_business, round(avg(schema_score), 9) AS avg_schema,
           round(sum(is_low_quality) / count(*), 9) AS low_quality_rate
        FROM scores s LEFT JOIN households h ON s.user_id = h.user_id GROUP BY 1, 2""",
    )
    add(
        "score_summary",
        "scores",
        """SELECT round(avg(quality_score), 9) AS avg_quality_score, round(min(quality_score), 9) AS min_quality_score,
           round(max(quality_score), 9) AS max_quality_score, CAST(sum(is_low_quality) AS BIGINT) AS low_quality_count FROM scores""",
    )
    add(
        "score_quantiles",
        "scores",
        " UNION ALL ".join(
            f"SELECT {p}::DOUBLE AS prob, round(quantile_cont(quality_score, {p}), 9) AS value FROM scores" for p in (0.2, 0.3, 0.4, 0.5, 0.6, 0.7)
        ),
    )

    # reports
    add(
        "worst_group_days",
        "keyed households",
        """SELECT acorn_group, score_date AS day, round(avg(quality_score), 9) AS avg_score, count(*) AS household_count
        FROM keyed k LEFT JOIN households h ON k.user_id = h.user_id
        WHERE score_date >= (SELECT max(score_date) FROM keyed) - INTERVAL 7 DAYS GROUP BY 1, 2
        ORDER BY avg(quality_score), day, acorn_group LIMIT 20""",
    )
    add(
        "incidents_daily",
        "incidents",
        """SELECT CAST(incident_timestamp AS DATE) AS day, rule_name, severity, count(*) AS incident_count,
           count(DISTINCT entity_id) AS affected_households FROM incidents
        WHERE incident_timestamp >= (SELECT max(CAST(incident_timestamp AS DATE)) FROM incidents) - INTERVAL 30 DAYS GROUP BY 1, 2, 3""",
    )
    add(
        "incident_counts_by_rule",
        "incidents",
        """SELECT rule_name, severity, count(*) AS incident_count, count(DISTINCT entity_id) AS affected_entities
        FROM incidents GROUP BY 1, 2""",
    )
    add(
        "incident_pivot",
        "incidents",
        """SELECT rule_name, count(*) FILTER (severity = 'critical') AS critical, count(*) FILTER (severity = 'warning') AS warning
        FROM incidents GROUP BY 1""",
    )
    add(
        "incident_timeline",
        "incidents",
        "SELECT CAST(incident_timestamp AS DATE) AS day, count(*) AS daily_incidents FROM incidents GROUP BY 1",
    )
    add(
        "next_day_predictions",
        "baseline",
        """SELECT entity_id, prediction_date, round(risk_score, 9) AS risk_score, risk_category FROM baseline
        WHERE prediction_date = (SELECT max(prediction_date) FROM baseline)
        ORDER BY baseline.risk_score DESC, entity_id LIMIT 100""",
    )
    add(
        "high_risk_entities",
        "baseline households",
        """SELECT b.*, acorn_group FROM (SELECT entity_id, prediction_date, round(risk_score, 9) AS risk_score, risk_category FROM baseline
          WHERE risk_score >= 0.4 ORDER BY baseline.risk_score DESC, entity_id, prediction_date LIMIT 50) b
        LEFT JOIN households h ON b.entity_id = CAST(h.user_id AS VARCHAR)""",
    )
    add(
        "worst_entities",
        "scores",
        """SELECT user_id, round(avg(quality_score), 9) AS avg_quality_score, count(*) AS days_with_data FROM scores GROUP BY 1
        ORDER BY avg(quality_score), user_id LIMIT 10""",
    )
    low = """SELECT t.*, acorn_group, tariff_type FROM (SELECT user_id, round(avg(quality_score), 9) AS avg_quality_score,
             round(min(quality_score), 9) AS min_quality_score, count(*) AS low_quality_days FROM scores WHERE quality_score < 70 GROUP BY 1
             ORDER BY low_quality_days DESC, avg(quality_score), user_id LIMIT 20) t LEFT JOIN households h ON t.user_id = h.user_id"""
    add("low_quality_entities", "scores households", low)
    add(
        "segment_low_days",
        "scores households",
        f"""SELECT acorn_group, CAST(sum(low_quality_days) AS BIGINT) AS total_low_quality_days, count(*) AS household_count
        FROM ({low}) GROUP BY 1""",
    )
    add(
        "score_histogram",
        "scores",
        """SELECT CAST(least(floor(quality_score / 2.0), 49) AS INTEGER) AS bin,
           CAST(least(floor(quality_score / 2.0), 49) AS INTEGER) * 2.0::DOUBLE AS bin_start, count(*) AS rows FROM scores GROUP BY 1, 2""",
    )
    add(
        "score_categories",
        "scores",
        """SELECT quality_category, count(*) AS rows, round(count(*) / (SELECT count(*) FROM scores), 9) AS share FROM scores GROUP BY 1""",
    )
    add(
        "score_statistics",
        "scores",
        """SELECT round(avg(quality_score), 9) AS mean, round(stddev_samp(quality_score), 9) AS std, round(min(quality_score), 9) AS min,
           round(max(quality_score), 9) AS max, count(*) AS total, CAST(sum(is_low_quality) AS BIGINT) AS low_count,
           round(sum(is_low_quality) / count(*), 9) AS low_share, round(quantile_cont(quality_score, 0.5), 9) AS median FROM scores""",
    )
    add(
        "daily_trend",
        "scores",
        """SELECT score_date AS day, round(avg(quality_score), 9) AS avg_quality_score, round(min(quality_score), 9) AS min_quality_score,
           round(max(quality_score), 9) AS max_quality_score, count(*) AS household_days FROM scores GROUP BY 1""",
    )
    add(
        "scores_by_segment",
        "scores households",
        """SELECT acorn_group, round(avg(quality_score), 9) AS avg_quality_score, round(min(quality_score), 9) AS min_quality_score,
           round(max(quality_score), 9) AS max_quality_score, count(*) AS total_records, CAST(sum(is_low_quality) AS BIGINT) AS low_quality_count,
           round(sum(is_low_quality) / count(*), 9) AS low_quality_rate
        FROM scores s LEFT JOIN households h ON s.user_id = h.user_id GROUP BY 1""",
    )
    weights = {"completeness_score": 0.40, "temporal_score": 0.25, "business_score": 0.20, "schema_score": 0.15}
    add(
        "component_breakdown",
        "scores",
        " UNION ALL ".join(
            f"""SELECT '{c}' AS component, round(avg({c}), 9) AS mean, {w}::DOUBLE AS weight,
            round(avg({c}) * {w}::DOUBLE * 100, 9) AS contribution FROM scores"""
            for c, w in weights.items()
        ),
    )
    add("score_dates", "keyed", "SELECT DISTINCT score_date FROM keyed")
    add(
        "risk_histogram",
        "baseline",
        """SELECT CAST(least(floor((risk_score - 0.0) / 0.02), 49) AS INTEGER) AS bin,
           round(CAST(least(floor((risk_score - 0.0) / 0.02), 49) AS INTEGER) * 0.02::DOUBLE, 9) AS bin_start, count(*) AS rows
        FROM baseline WHERE risk_score BETWEEN 0 AND 1 GROUP BY 1, 2""",
    )
    add(
        "risk_categories",
        "baseline",
        "SELECT risk_category, count(*) AS rows, round(count(*) / (SELECT count(*) FROM baseline), 9) AS share FROM baseline GROUP BY 1",
    )
    add(
        "risk_statistics",
        "baseline",
        """SELECT round(avg(risk_score), 9) AS mean, round(stddev_samp(risk_score), 9) AS std, round(min(risk_score), 9) AS min,
           round(max(risk_score), 9) AS max, count(*) AS total, round(quantile_cont(risk_score, 0.5), 9) AS median FROM baseline""",
    )

    # features, labels, evaluation
    add("incident_features", "incident_counts", "SELECT * FROM incident_counts")
    add(
        "consumption_features",
        "consumption",
        """SELECT entity_id, score_date, reading_count, """
        + ", ".join(
            f"round({c}, 9) AS {c}"
            for c in (
                "avg_consumption std_consumption min_consumption max_consumption avg_temperature min_temperature max_temperature "
                "avg_humidity consumption_cv"
            ).split()
        )
        + ", CAST(dayofweek(score_date) + 1 AS INTEGER) AS day_of_week, CAST(month(score_date) AS INTEGER) AS month FROM consumption",
    )
    add("rolling_features", "feature_rows", "SELECT * FROM feature_rows")
    add("rolling_features_before_today", "feature_rows_before", "SELECT * FROM feature_rows_before")
    add(
        "labels_next_day",
        "labels",
        "SELECT entity_id, score_date, round(future_quality_score, 9) AS future_quality_score, future_incident_count, target FROM labels",
    )
    add(
        "labels_median_threshold",
        "keyed incident_counts",
        """SELECT k.entity_id, k.score_date,
           CASE WHEN f.quality_score < (SELECT quantile_cont(quality_score, 0.5) FROM keyed) OR coalesce(i.total_incidents, 0) >= 1
             THEN 1 ELSE 0 END AS target
        FROM keyed k JOIN keyed f ON k.entity_id = f.entity_id AND k.score_date = f.score_date - 1
        LEFT JOIN incident_counts i ON k.entity_id = i.entity_id AND k.score_date = i.score_date - 1""",
    )
    add("training_set", "feature_rows labels", "SELECT f.*, target FROM feature_rows f JOIN labels l USING (entity_id, score_date)")
    add(
        "train_test_split",
        "labels",
        """SELECT entity_id, score_date, target, CASE WHEN place <= floor(n * 0.8 + 1e-9) THEN 1 ELSE 0 END AS is_train
        FROM (SELECT *, row_number() OVER (PARTITION BY target ORDER BY h, entity_id, score_date) AS place,
                count(*) OVER (PARTITION BY target) AS n
              FROM (SELECT entity_id, score_date, target,
                      ('0x' || substr(md5('42|' || entity_id || '|' || CAST(score_date AS VARCHAR)), 1, 12))::BIGINT AS h FROM labels))""",
    )
    add(
        "time_split",
        "labels",
        """SELECT entity_id, score_date, target, CASE WHEN score_date >= edge THEN 'test' WHEN score_date > edge - 3 THEN 'gap' ELSE 'train' END AS part
        FROM labels, (SELECT min(score_date) AS edge FROM (
          SELECT score_date, sum(count(*)) OVER (ORDER BY score_date) - count(*) AS before, sum(count(*)) OVER () AS n FROM labels GROUP BY 1)
          WHERE before >= 0.8 * n)""",
    )
    add(
        "ranking_metrics",
        "judged",
        """SELECT positives, negatives, round(auc, 9) AS auc, round(average_precision, 9) AS average_precision FROM
          (SELECT count(*) FILTER (target = 1) AS positives, count(*) FILTER (target = 0) AS negatives FROM judged),
          (SELECT avg(CASE WHEN p.risk_score > q.risk_score THEN 1 WHEN p.risk_score = q.risk_score THEN 0.5 ELSE 0 END::DOUBLE) AS auc
           FROM judged p JOIN judged q ON p.target = 1 AND q.target = 0),
          (SELECT avg(share) AS average_precision FROM (SELECT target, avg(target) OVER (ORDER BY risk_score DESC) AS share FROM judged) WHERE target = 1)""",
    )
    add(
        "predicted_days",
        "feature_rows",
        """SELECT entity_id, score_date + 1 AS prediction_date, true AS fits FROM feature_rows
        WHERE score_date IN ((SELECT max(score_date) FROM feature_rows), (SELECT min(score_date) FROM feature_rows))""",
    )
    add(
        "prediction_reports",
        "feature_rows",
        """SELECT unnest(['categories', 'histogram', 'statistics', 'newest_day']) AS report, unnest([n, n, n, least(100, newest)]) AS rows
        FROM (SELECT count(*) AS n, count(*) FILTER (score_date = (SELECT max(score_date) FROM feature_rows)) AS newest FROM feature_rows
              WHERE score_date IN ((SELECT max(score_date) FROM feature_rows), (SELECT min(score_date) FROM feature_rows)))""",
    )
    add(
        "class_weights",
        "labels",
        """SELECT target, count(*) AS rows, round(CASE WHEN target = 1 THEN (SELECT count(*) FROM labels WHERE target = 0) / count(*) ELSE 1 END, 9)
           AS weight FROM labels GROUP BY 1""",
    )
    add(
        "confusion_counts",
        "judged",
        "SELECT target AS label, CASE WHEN risk_score >= 0.3 THEN 1 ELSE 0 END AS prediction, count(*) AS rows FROM judged GROUP BY 1, 2",
    )
    add(
        "class_report",
        "judged",
        """SELECT class, round(p, 9) AS precision, round(r, 9) AS recall, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 9) AS f1, support
        FROM (SELECT class, coalesce(count(*) FILTER (target = class AND said = class) / nullif(count(*) FILTER (said = class), 0), 0) AS p,
                coalesce(count(*) FILTER (target = class AND said = class) / nullif(count(*) FILTER (target = class), 0), 0) AS r,
                count(*) FILTER (target = class) AS support
              FROM (SELECT target, CASE WHEN risk_score >= 0.3 THEN 1 ELSE 0 END AS said, unnest([0, 1]) AS class FROM judged) GROUP BY 1)""",
    )
    add(
        "calibration",
        "judged",
        """SELECT least(CAST(floor(risk_score * 10) AS INTEGER) + 1, 10) AS bin, count(*) AS rows, round(avg(risk_score), 9) AS mean_predicted,
           round(avg(target), 9) AS observed_rate FROM judged GROUP BY 1""",
    )

    # versioned tables
    add(
        "version_compare",
        "",
        """SELECT 0::BIGINT AS version1, 1::BIGINT AS version2, count(*) AS count_v1, count(*) FILTER (event_type <> 'signup') AS count_v2,
           count(*) FILTER (event_type <> 'signup') - count(*) AS row_diff, true AS schema_equal, 0::BIGINT AS added,
           count(*) FILTER (event_type = 'signup') AS removed, count(*) FILTER (event_type = 'error') AS changed FROM events""",
    )
    add("restore_version", "", "SELECT event_id, user_id, value FROM events")
    add(
        "version_history",
        "",
        """SELECT 0::BIGINT AS version, 'overwrite' AS operation, count(*) AS rows_written FROM events
        UNION ALL SELECT 1, 'append', count(*) FROM events UNION ALL SELECT 2, 'restore', 0
        UNION ALL SELECT 3, 'optimize', count(*) FROM events""",
    )
    add(
        "schema_evolution",
        "",
        """SELECT event_id, value, NULL AS event_type FROM events UNION ALL SELECT event_id, event_id, event_type FROM events""",
    )
    add(
        "schema_diff",
        "",
        """SELECT * FROM (VALUES ('event_id', 'same', 'bigint', 'bigint'), ('user_id', 'type_differs', 'bigint', 'string'),
           ('value', 'only_in_table1', 'double', NULL), ('source', 'only_in_table2', NULL, 'string')) t("column", status, type_1, type_2)""",
    )
    add("zorder_rewrite", "", "SELECT event_id, user_id, ts, value FROM events")
    # raw files and streams
    raw = """SELECT CAST(user_id AS VARCHAR) AS household_id, date_trunc('second', ts) AS timestamp, value AS energy_kwh,
           CAST(event_id // 1000 AS VARCHAR) AS source_block FROM dirty"""
    add("csv_readings", "dirty", raw)
    add(
        "csv_daily",
        "",
        """SELECT CAST(user_id AS VARCHAR) AS household_id, CAST(ts AS DATE) AS date, round(sum(value), 9) AS energy_sum_kwh,
           round(median(value), 9) AS energy_median_kwh, round(avg(value), 9) AS energy_mean_kwh, round(max(value), 9) AS energy_max_kwh,
           round(min(value), 9) AS energy_min_kwh, round(stddev_samp(value), 9) AS energy_std_kwh,
           count(*)::DOUBLE AS energy_count, CAST(user_id // 50 AS VARCHAR) AS source_block FROM events GROUP BY ALL""",
    )
    add(
        "csv_weather_hourly",
        "weather",
        """SELECT hour_at AS timestamp, round(temperature_celsius, 9) AS temperature_celsius, round(humidity_ratio, 9) AS humidity_ratio,
           weather_summary FROM weather""",
    )
    add(
        "stream_weather",
        "weather",
        """SELECT hour_at AS timestamp, round(temperature_celsius, 9) AS temperature_celsius, round(humidity_ratio, 9) AS humidity_ratio,
           weather_summary FROM weather""",
    )
    add("replayed_batches", "", "SELECT event_id, user_id, round(value, 9) AS value, (event_id % 3)::INTEGER AS batch FROM events")
    add(
        "repeated_predictions",
        "baseline",
        """SELECT entity_id, prediction_date, round(risk_score, 9) AS risk_score, risk_category,
             CASE WHEN nth = 1 THEN 'again' END AS model_version
           FROM (SELECT *, dense_rank() OVER (ORDER BY prediction_date DESC) AS nth FROM baseline) WHERE nth <= 2""",
    )
    add(
        "csv_weather_daily",
        "",
        """SELECT CAST(ts AS DATE) AS date, max(value) AS temp_max_celsius, min(value) AS temp_min_celsius, max(event_type) AS weather_summary
        FROM events GROUP BY 1""",
    )
    add(
        "csv_households",
        "",
        """SELECT CAST(c_custkey AS VARCHAR) AS household_id, CASE WHEN c_acctbal < 0 THEN ' tou ' ELSE 'Std' END AS tariff_type,
           'ACORN-' || c_mktsegment[1] AS acorn_code, ' ' || c_mktsegment AS acorn_group,
           'block_' || CAST(c_custkey % 16 AS VARCHAR) AS source_block FROM customer""",
    )
    add("csv_holidays", "holidays", "SELECT holiday_date FROM holidays")
    add(
        "csv_segments",
        "",
        """SELECT CAST(p_partkey AS VARCHAR) AS part_key, p_brand AS brand_name_, p_type AS brand_name__2 FROM part""",
    )
    add("optional_source", "holidays", "SELECT holiday_date FROM holidays")
    add("stream_ingest", "dirty", raw)
    add("stream_dedupe", "dirty", "SELECT DISTINCT user_id, ts FROM dirty WHERE ts IS NOT NULL")
    add(
        "stream_completeness",
        "dirty",
        """SELECT user_id, CAST(ts AS DATE) AS score_date, count(*) AS actual_records, 3::BIGINT AS expected_records,
           round(1 - count(*) / 3.0::DOUBLE, 9) AS missing_rate, count(*) FILTER (value < 0) AS negative_count,
           count(*) FILTER (value > 100) AS above_max_count, count(*) FILTER (coalesce(NOT value BETWEEN 0 AND 400, true)) AS out_of_range_count,
           count(*) FILTER (event_type = 'bogus') AS invalid_event_type_count FROM dirty WHERE ts IS NOT NULL GROUP BY 1, 2""",
    )
    add(
        "stream_cadence",
        "dirty",
        """SELECT user_id, cadence, count(*) AS rows FROM (
          SELECT user_id, CASE WHEN seen IS NULL THEN 'ok' WHEN ts < seen THEN 'late' WHEN ts = seen THEN 'duplicate'
            WHEN abs(date_diff('microsecond', seen, ts) / 60000000.0 - 480) > 240 THEN 'gap' ELSE 'ok' END AS cadence
          FROM (SELECT user_id, ts, max(ts) OVER (PARTITION BY user_id ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen
                FROM dirty WHERE ts IS NOT NULL)) GROUP BY 1, 2""",
    )

    # whole runs
    again = ", ".join(f"'{t}'" for t in _LAKE_AGAIN)
    used = ", ".join(sorted({f"'{source}'" for made_of in _LAKE_EDGES.values() for source in made_of.split()}))
    edges = ", ".join(
        f"('{source}', {0 if '/' in source else 'NULL'}, '{target}', 0)" for target, made_of in _LAKE_EDGES.items() for source in made_of.split()
    )
    edges += "".join(f", ('{_LAKE_EDGES[t]}', NULL, '{t}', 1)" for t in _LAKE_AGAIN)
    add("layer_run", "lake_rows", """SELECT 'SUCCESS' AS status, "table", rows FROM lake_rows""")
    add(
        "latest_run",
        "lake_rows",
        f"""SELECT 'batch_run' AS pipeline_name, 'FAILED' AS status, "table", rows FROM lake_rows WHERE "table" IN ({again})""",
    )
    add(
        "audit_runs",
        "lake_rows",
        f"""SELECT 'batch_run' AS pipeline_name, 'SUCCESS' AS status, "table", rows,
           CASE WHEN "table" IN ({used}) THEN 0::BIGINT END AS version_read, 0::BIGINT AS version_written FROM lake_rows""",
    )
    add(
        "run_lineage",
        "lake_rows",
        f"""SELECT r.*, rows FROM (WITH RECURSIVE edges(source, source_version, target, version) AS (VALUES {edges}),
          reached AS (SELECT source AS start, source_version AS start_version, target AS path, version, 1 AS steps FROM edges
            UNION SELECT start, start_version, target, e.version, steps + 1 FROM reached r JOIN edges e ON e.source = r.path AND e.source_version = r.version)
          SELECT start, start_version::BIGINT AS start_version, path, version::BIGINT AS version, min(steps)::INTEGER AS steps FROM reached GROUP BY ALL) r
        JOIN lake_rows ON "table" = path""",
    )

    # geography: areas are L-shaped with a square hole, on a grid by nation
    part(
        "areas",
        "",
        """SELECT n_nationkey AS k, n_name, r_name, (n_nationkey % 5)::DOUBLE AS x0, 50 + (n_nationkey // 5)::DOUBLE AS y0
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    )
    part(
        "buildings",
        "",
        """SELECT *, 111195.07973436875 * cos(radians(y)) * 0.0001 * 111195.07973436875 * 0.0002 AS area_m2
        FROM (SELECT p_partkey, p_size, p_type, (p_partkey * 37 % 5000) / 1000.0::DOUBLE + 0.00055 AS x,
                50 + (p_partkey * 91 % 5000) / 1000.0::DOUBLE + 0.0006 AS y FROM part)""",
    )
    part(
        "located",
        "areas buildings",
        """SELECT a.*, b.* FROM areas a JOIN buildings b ON x > x0 AND x < x0 + 0.9 AND y > y0 AND y < y0 + 0.9
          AND (x < x0 + 0.5 OR y < y0 + 0.5)
          AND NOT (x > x0 + 0.1 AND x < x0 + 0.3 AND y > y0 + 0.1 AND y < y0 + 0.3)""",
    )
    totals = """SELECT 'A' || k AS admin_area_id, n_name AS admin_area_name, count(p_partkey) AS building_count,
           round(coalesce(sum(area_m2), 0), 2) AS total_area_m2
        FROM areas LEFT JOIN located USING (k, n_name) GROUP BY 1, 2"""
    add("buildings_by_area", "located", totals)
    add(
        "top_areas",
        "located",
        f"SELECT * FROM ({totals}) ORDER BY building_count DESC, admin_area_id LIMIT 50",
    )
    add(
        "areas_without_ids",
        "located",
        f"""SELECT (row_number() OVER (ORDER BY admin_area_name) - 1)::VARCHAR AS admin_area_id, admin_area_name, building_count, total_area_m2
            FROM ({totals})""",
    )
    part(
        "zones",
        "",
        """SELECT p_partkey AS z, bx + s[ix + 1] AS zx1, bx + s[ix + 2 + ((p_partkey * 7) // 9) % (9 - ix)] AS zx2,
             y0z + s[iy + 1] AS zy1, y0z + s[iy + 2 + (ky // 9) % (9 - iy)] AS zy2
           FROM (SELECT p_partkey, (p_partkey % 5)::DOUBLE AS bx, 50 + (p_partkey // 5 % 5)::DOUBLE AS y0z, p_partkey * 7 % 9 AS ix,
                   p_partkey * 11 + p_partkey // 25 AS ky, (p_partkey * 11 + p_partkey // 25) % 9 AS iy,
                   [0.0::DOUBLE, 0.1::DOUBLE, 0.15::DOUBLE, 0.2::DOUBLE, 0.3::DOUBLE, 0.4::DOUBLE, 0.5::DOUBLE, 0.7::DOUBLE, 0.9::DOUBLE, 1.0::DOUBLE] AS s FROM part)""",
    )
    corners = {
        "outer": ((0, 0), (0.9, 0), (0.9, 0.5), (0.5, 0.5), (0.5, 0.9), (0, 0.9), (0, 0)),
        "hole": ((0.1, 0.1), (0.3, 0.1), (0.3, 0.3), (0.1, 0.3), (0.1, 0.1)),
    }
    sides = ", ".join(
        f"{{'x1': x0 + {a[0]}::DOUBLE, 'y1': y0 + {a[1]}::DOUBLE, 'x2': x0 + {b[0]}::DOUBLE, 'y2': y0 + {b[1]}::DOUBLE}}"
        for ring in corners.values()
        for a, b in zip(ring, ring[1:], strict=False)
    )
    zone = ["zx1", "zy1", "zx2", "zy1", "zx2", "zy2", "zx1", "zy2", "zx1", "zy1"]
    zone_sides = ", ".join(
        "{" + ", ".join(f"'{n}': {zone[i + j]}" for j, n in enumerate(("x1", "y1", "x2", "y2"))) + "}" for i in range(0, 8, 2)
    )
    part("area_sides", "areas", f"SELECT k, unnest([{sides}]) AS e FROM areas")
    part("zone_sides", "zones", f"SELECT z, unnest([{zone_sides}]) AS e FROM zones")
    turn = "sign(({a}.x2 - {a}.x1) * ({b}.y{i} - {a}.y1) - ({a}.y2 - {a}.y1) * ({b}.x{i} - {a}.x1))"
    across = [
        " * ".join(turn.format(a=f"{p}.e", b=f"{q}.e", i=i) for i in (1, 2)) + " <= 0" for p, q in (("a", "b"), ("b", "a"))
    ]
    boxes = [
        f"least({p}.e.{c}1, {p}.e.{c}2) <= greatest({q}.e.{c}1, {q}.e.{c}2)" for c in "xy" for p, q in (("a", "b"), ("b", "a"))
    ]
    in_zone = "zx1 < x0 + {d}::DOUBLE AND x0 + {d}::DOUBLE < zx2 AND zy1 < y0 + {d}::DOUBLE AND y0 + {d}::DOUBLE < zy2"
    add(
        "areas_touching",
        "area_sides zone_sides",
        f"""SELECT * FROM (WITH met AS (SELECT DISTINCT k, z FROM area_sides a JOIN zone_sides b ON {" AND ".join(boxes + across)}),
              held AS (SELECT k, z FROM areas JOIN zones ON ({in_zone.format(d=0)}) OR ({in_zone.format(d=0.1)})
                OR (zx1 > x0 AND zx1 < x0 + 0.9::DOUBLE AND zy1 > y0 AND zy1 < y0 + 0.9::DOUBLE AND (zx1 < x0 + 0.5::DOUBLE OR zy1 < y0 + 0.5::DOUBLE)
                  AND NOT (zx1 > x0 + 0.1::DOUBLE AND zx1 < x0 + 0.3::DOUBLE AND zy1 > y0 + 0.1::DOUBLE AND zy1 < y0 + 0.3::DOUBLE)))
            SELECT 'A' || k AS left_id, z::VARCHAR AS right_id, bool_or(m) AS boundaries_meet
            FROM (SELECT k, z, true AS m FROM met UNION ALL SELECT k, z, false FROM held) GROUP BY k, z)""",
    )
    add("points_in_areas", "located", "SELECT p_partkey AS building_key, 'A' || k AS area_id FROM located")
    add(
        "osm_buildings",
        "buildings",
        """SELECT 'way_' || p_partkey AS building_id,
           CASE WHEN p_partkey % 50 = 0 THEN 'shed' WHEN p_size > 25 THEN 'unknown' ELSE 'yes' END AS building_type,
           CASE WHEN p_size > 25 THEN 'retail' END AS landuse, CASE WHEN p_partkey % 70 <> 0 THEN round(area_m2, 3) END AS area_m2,
           CASE WHEN p_partkey % 70 = 0 THEN 4 ELSE 5 END AS corners, CASE WHEN p_partkey % 70 = 0 THEN 1 ELSE 0 END AS missing_nodes,
           CASE WHEN p_partkey % 50 = 0 THEN 'photo' ELSE 'survey' END AS source FROM buildings""",
    )
    add(
        "admin_areas_level2",
        "areas",
        """SELECT 'A' || k AS gid_2, r_name AS country, r_name AS region, 'county ' || k AS county, 2 AS admin_level, 2 AS ring_count
           FROM areas""",
    )
    add(
        "temporal_metrics_open_arrivals",
        "dirty",
        """SELECT * FROM (WITH r AS (SELECT user_id, ts, CASE WHEN event_id % 43 <> 0 THEN arrival - arrival % 2 END AS arrival FROM dirty WHERE ts IS NOT NULL),
           d AS (SELECT user_id, ts, arrival, count(*) AS n FROM r GROUP BY 1, 2, 3),
           l AS (SELECT user_id, ts, arrival, ts < lag(ts) OVER (PARTITION BY user_id ORDER BY arrival, ts) AS late FROM d WHERE arrival IS NOT NULL),
           t AS (SELECT d.user_id, d.ts, sum(n) AS n, count(*) FILTER (late) AS late,
                   coalesce(arg_min(coalesce(late, false), coalesce(d.arrival, -1)), false) AS first_late
                 FROM d LEFT JOIN l ON d.user_id = l.user_id AND d.ts = l.ts AND d.arrival = l.arrival GROUP BY 1, 2),
           g AS (SELECT *, coalesce(abs(date_diff('microsecond', lag(ts) OVER (PARTITION BY user_id ORDER BY ts), ts) / 60000000.0 - 480) > 240, false) AS gap FROM t),
           e AS (SELECT user_id, CAST(ts AS DATE) AS score_date, n AS total_records, CAST(gap AS INT) AS gap_count, n - 1 AS duplicate_count,
                   late AS out_of_order_count, CAST(gap OR first_late AS INT) + n - 1 AS anomalous_records FROM g
                 UNION ALL SELECT user_id, NULL, 1, 0, 0, 0, 0 FROM dirty WHERE ts IS NULL)
           SELECT user_id, score_date, CAST(sum(total_records) AS BIGINT) AS total_records, CAST(sum(gap_count) AS BIGINT) AS gap_count,
             CAST(sum(duplicate_count) AS BIGINT) AS duplicate_count, CAST(sum(out_of_order_count) AS BIGINT) AS out_of_order_count,
             CAST(sum(anomalous_records) AS BIGINT) AS anomalous_records FROM e GROUP BY 1, 2)""",
    )
    add(
        "admin_areas",
        "areas",
        """SELECT 'A' || k AS gid_3, r_name AS country, r_name AS region, 'county ' || k AS county, n_name AS district, 3 AS admin_level,
           2 AS ring_count, 0.9 * 0.9 - 0.4 * 0.4 AS outer_area FROM areas""".replace("0.9 * 0.9 - 0.4 * 0.4", "0.65::DOUBLE"),
    )
    return q
