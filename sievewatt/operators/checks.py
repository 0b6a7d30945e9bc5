"""The four families of quality checks. Each returns (metrics per entity and day, incidents).

Metrics come from aggregates with map-side combining, and the rate in each is rows with at least one
hit over all rows. Rows without a time form a day of their own (null) instead of vanishing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievewatt.config import CheckSettings, Cols
from sievewatt.functions.columns import MINUTES_PER_DAY, day, entity_id, flag, minutes_between, number
from sievewatt.operators.ordered import previous_value
from sievewatt.operators.skew import HOT_ROWS, Slices, find_slices, lookup_join, outer_merge
from sievewatt.runtime import BROADCAST_BYTES

DAY = "score_date"

INCIDENT_COLUMNS = ["entity_id", "score_date", "incident_timestamp", "rule_name", "severity", "evidence"]


@dataclass(frozen=True)
class Rule:
    """A row-level rule: hits of ``when`` become incidents called ``name``."""

    name: str
    count: str
    when: Column
    severity: str = "warning"
    evidence: Column | None = None


# ---------------------------------------------------------------- completeness


def completeness(
    df: DataFrame,
    cols: Cols,
    interval: int = 30,
    threshold: float | None = None,
    grain: str = "day",
    spine: bool = False,
    critical: float = 0.25,
) -> tuple[DataFrame, DataFrame]:
    """Readings present against readings expected, per entity and day or week.

    ``spine=True`` adds a row for every day between an entity's first and last on which it sent
    nothing at all.
    """
    if threshold is None:
        threshold = 0.10 if grain == "day" else 0.25
    daily = df.groupBy(*cols.entity, day(cols.ts).alias(DAY)).agg(
        F.count(F.lit(1)).alias("actual_records"),
        F.count(cols.ts).alias("non_null_records"),
        F.min(cols.ts).alias("min_timestamp"),
        F.max(cols.ts).alias("max_timestamp"),
    )
    return _completeness_from_daily(daily, df, cols, interval, threshold, grain, spine, critical)


def _completeness_from_daily(daily, df, cols, interval, threshold, grain, spine, critical):
    if spine:
        daily = _fill_days(daily, cols)
    days = 1
    if grain == "week":
        days = 7
        daily = daily.groupBy(*cols.entity, F.to_date(F.date_trunc("week", F.col(DAY))).alias(DAY)).agg(
            F.sum("actual_records").alias("actual_records"),
            F.sum("non_null_records").alias("non_null_records"),
            F.min("min_timestamp").alias("min_timestamp"),
            F.max("max_timestamp").alias("max_timestamp"),
        )
    elif grain != "day":
        raise ValueError(f"unknown grain {grain!r}")
    expected = int(MINUTES_PER_DAY / interval) * days
    rate = F.col("actual_records") / F.lit(float(expected))
    metrics = daily.withColumns(
        {
            "expected_records": F.lit(expected).cast("long"),
            "missing_records": F.lit(expected) - F.col("actual_records"),
            "completeness_rate": rate,
            "missing_rate": 1 - rate,
            "completeness_error": flag(1 - rate > threshold),
        }
    )
    stamp = F.col(DAY).cast(df.schema[cols.ts].dataType)
    incidents = metrics.filter(F.col("missing_rate") > threshold).select(
        entity_id(cols.entity).alias("entity_id"),
        DAY,
        stamp.alias("incident_timestamp"),
        F.lit("completeness_high_missing_rate").alias("rule_name"),
        F.when(F.col("missing_rate") > critical, "critical").otherwise("warning").alias("severity"),
        F.concat_ws(
            "|",
            F.col("actual_records").cast("string"),
            F.col("expected_records").cast("string"),
            (F.col("missing_rate") * 100).cast("string"),
        ).alias("evidence"),
    )
    return metrics, incidents


def _fill_days(daily: DataFrame, cols: Cols) -> DataFrame:
    """One row per entity and day of its life; days it skipped count zero.

    The days are generated per entity inside the job and merged by one grouping, without a join.
    """
    span = daily.filter(F.col(DAY).isNotNull()).groupBy(*cols.entity).agg(
        F.min(DAY).alias("_from"), F.max(DAY).alias("_to")
    )
    zero = F.lit(0).cast("long")
    empty = span.select(
        *cols.entity,
        F.explode(F.sequence("_from", "_to")).alias(DAY),
        zero.alias("actual_records"),
        zero.alias("non_null_records"),
    )
    return outer_merge([daily, empty], [*cols.entity, DAY])


# -------------------------------------------------------------------- temporal


def timeline_flags(
    df: DataFrame,
    cols: Cols,
    interval: float = 30,
    tolerance: float = 1,
    rows_per_slice: int | None = None,
) -> DataFrame:
    """One row per entity and time: how many readings it has and what is wrong with them.

    In order of time (and of arrival among equal times) a reading is a duplicate if it repeats the
    time before it, otherwise a gap if its distance from it is off by more than the tolerance. In
    order of arrival it is late if its time lies before that of the reading that came before it. An
    entity's first reading is never wrong. Readings without an arrival have no place in that order: they
    are not late and make no other late. Readings equal in time and arrival are late once at most.

    Without hot entities the readings are shuffled by entity once and everything happens there. With
    them, they are first reduced to distinct times and arrivals, whose windows can then be cut into
    slices; so it does not matter how many readings an entity has or how often one is repeated.
    """
    arrival = cols.arrival if cols.arrival in df.columns and cols.arrival != cols.ts else None
    timed = df.filter(F.col(cols.ts).isNotNull())
    by_time = find_slices(timed, cols.entity, cols.ts, rows_per_slice)
    by_arrival = find_slices(timed, cols.entity, arrival, rows_per_slice) if arrival else by_time
    if by_time.table is None and by_arrival.table is None:
        times = _times_by_entity(timed, cols, arrival)
    else:
        times = previous_value(_distinct_times(timed, cols, arrival, by_arrival), cols.ts, "prev_timestamp", by_time)
    diff = minutes_between(F.col(cols.ts), F.col("prev_timestamp"))
    return times.withColumns({"time_diff_minutes": diff, "is_gap": flag(F.abs(diff - interval) > tolerance)})


def _times_by_entity(timed: DataFrame, cols: Cols, arrival: str | None) -> DataFrame:
    """(entity, time, readings, late_readings, first_is_late, prev_timestamp) in one shuffle: both
    windows and the grouping use the partitioning by entity."""
    ts, entity = F.col(cols.ts), Window.partitionBy(*cols.entity)
    columns = [*cols.entity, cols.ts] + ([arrival] if arrival else [])
    # Equal rows become one, so that both orders below are total.
    once = timed.select(*columns).repartition(*cols.entity).groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    rows = once.withColumn("_prev", F.lag(cols.ts).over(entity.orderBy(*columns[len(cols.entity) :])))
    late = F.lit(False)
    if arrival:
        came = F.when(F.col(arrival).isNotNull(), ts)
        late = F.coalesce(came < F.lag(came).over(entity.orderBy(arrival, cols.ts)), F.lit(False))
    first = F.col("_prev").isNull() | (F.col("_prev") != ts)
    return (
        rows.withColumn("_late", late)
        .groupBy(*cols.entity, cols.ts)
        .agg(
            F.sum("_n").alias("readings"),
            F.count_if("_late").alias("late_readings"),
            F.coalesce(F.max(F.when(first, F.col("_late"))), F.lit(False)).alias("first_is_late"),
            F.max(F.when(first, F.col("_prev"))).alias("prev_timestamp"),
        )
    )


def _distinct_times(timed: DataFrame, cols: Cols, arrival: str | None, by_arrival: Slices) -> DataFrame:
    """The same without ``prev_timestamp``, by aggregates that combine before they shuffle."""
    keys = [*cols.entity, cols.ts]
    if not arrival:
        none = [F.lit(0).cast("long").alias("late_readings"), F.lit(False).alias("first_is_late")]
        return timed.groupBy(*keys).agg(F.count(F.lit(1)).alias("readings"), *none)
    nothing = F.lit(None).cast(timed.schema[arrival].dataType)
    came = timed.select(*keys, F.lit(1).alias("_n"), F.col(arrival).alias("_came"), nothing.alias("_late"))
    late = _late_arrivals(timed, cols, arrival, by_arrival).select(
        *keys, F.lit(0).alias("_n"), nothing.alias("_came"), F.col(arrival).alias("_late")
    )
    return (
        came.unionByName(late)
        .groupBy(*keys)
        .agg(
            F.sum("_n").alias("readings"),
            F.count("_late").alias("late_readings"),
            # Of the readings of one time, one without an arrival is the first.
            F.coalesce(
                (F.min("_late") == F.min("_came")) & ~F.max((F.col("_n") == 1) & F.col("_came").isNull()), F.lit(False)
            ).alias("first_is_late"),
        )
    )


def _late_arrivals(timed: DataFrame, cols: Cols, arrival: str, slices: Slices) -> DataFrame:
    """(entity, time, arrival) of the readings that came after a later one.

    Readings that arrived together count as sorted by time, so only the earliest of them can be late,
    and it is compared with the latest of those that arrived before. This needs one row per entity
    and arrival, whether every reading has its own or a whole batch shares one.
    """
    together = timed.filter(F.col(arrival).isNotNull()).groupBy(*cols.entity, arrival).agg(F.min(cols.ts).alias(cols.ts), F.max(cols.ts).alias("_last"))
    return previous_value(together, "_last", "_before", slices).filter(F.col(cols.ts) < F.col("_before"))


def temporal(
    df: DataFrame,
    cols: Cols,
    interval: float = 30,
    tolerance: float = 1,
    threshold: float = 0.05,
    all_rules: bool = False,
    rows_per_slice: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Cadence: gaps, duplicates and late arrivals."""
    flags = timeline_flags(df, cols, interval, tolerance, rows_per_slice)
    metrics = _temporal_metrics(df, flags, cols, threshold)
    return metrics, _one_per_rule(_temporal_hits(flags, cols, all_rules))


def _temporal_hits(flags: DataFrame, cols: Cols, all_rules: bool) -> DataFrame:
    gap, repeated = F.col("is_gap") == 1, F.col("readings") > 1
    # Repeats are reported as such; only the first reading of a time can be reported as late.
    late = (F.col("late_readings") > 0) if all_rules else F.col("first_is_late") & ~gap
    minutes = F.concat(F.col("time_diff_minutes").cast("string"), F.lit("||"))
    rules = [
        Rule("temporal_gap", "", gap, evidence=minutes),
        Rule("temporal_duplicate", "", repeated, evidence=F.lit("|duplicate|")),
        Rule("temporal_out_of_order", "", late, evidence=F.lit("||out_of_order")),
    ]
    return _hits(flags, cols, [rules], all_rules=True)


def _temporal_metrics(df: DataFrame, flags: DataFrame, cols: Cols, threshold: float) -> DataFrame:
    repeats = F.col("readings") - 1
    first_is_wrong = ((F.col("is_gap") == 1) | F.col("first_is_late")).cast("long")
    zero = F.lit(0).cast("long")
    sums = ["total_records", "gap_count", "duplicate_count", "out_of_order_count", "anomalous_records"]
    timed = flags.select(
        *cols.entity,
        day(cols.ts).alias(DAY),
        F.col("readings").alias("total_records"),
        F.col("is_gap").cast("long").alias("gap_count"),
        repeats.alias("duplicate_count"),
        F.col("late_readings").alias("out_of_order_count"),
        (first_is_wrong + repeats).alias("anomalous_records"),
    )
    untimed = df.filter(F.col(cols.ts).isNull()).select(
        *cols.entity, F.lit(None).cast("date").alias(DAY), F.lit(1).cast("long").alias(sums[0]), *[zero.alias(c) for c in sums[1:]]
    )
    per_day = timed.unionByName(untimed).groupBy(*cols.entity, DAY).agg(*[F.sum(c).alias(c) for c in sums])
    return per_day.withColumns(
        {
            "total_anomalies": F.col("gap_count") + F.col("duplicate_count") + F.col("out_of_order_count"),
            "anomaly_rate": F.col("anomalous_records") / F.col("total_records"),
        }
    ).withColumn("temporal_coherence_error", flag(F.col("anomaly_rate") > threshold))


# -------------------------------------------------------------------- business


def with_entity_stats(
    df: DataFrame,
    cols: Cols,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add the mean and sample deviation of the entity's whole history.

    Aggregate and join back rather than a window over the entity: the aggregate combines map-side,
    and with the statistics broadcast the readings themselves are never shuffled.
    """
    v = number(cols.value)
    stats = df.groupBy(*cols.entity).agg(F.avg(v).alias("mean_value"), F.stddev_samp(v).alias("std_value"))
    return lookup_join(
        df,
        stats,
        cols.entity,
        broadcast_bytes=broadcast_bytes,
        hot_rows=hot_rows,
        small_is_summary_of_big=True,
    )


def z_score(cols: Cols) -> Column:
    known = (F.col("std_value") > 0) & number(cols.value).isNotNull()
    return F.when(known, (number(cols.value) - F.col("mean_value")) / F.col("std_value")).otherwise(0.0)


def business_rules(cols: Cols, low: float, high: float, z: float) -> list[Rule]:
    """Rules on a frame from ``with_entity_stats``, most serious first."""
    v, score = number(cols.value), z_score(cols)
    text = v.cast("string")
    return [
        Rule("business_negative_consumption", "negative_count", v < low, "critical", F.concat(text, F.lit("||"))),
        Rule("business_above_max", "above_max_count", v > high, "warning", F.concat(F.lit("|"), text, F.lit("|"))),
        Rule(
            "business_extreme_spike",
            "extreme_spike_count",
            F.abs(score) > z,
            "warning",
            F.concat(F.lit("||"), score.cast("string")),
        ),
    ]


def business(
    df: DataFrame,
    cols: Cols,
    low: float = 0.0,
    high: float = 50.0,
    z: float = 5.0,
    threshold: float = 0.01,
    all_rules: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Negative values, values above the cap, and spikes against the entity's own history."""
    rows = with_entity_stats(df, cols)
    rules = business_rules(cols, low, high, z)
    metrics = _rule_metrics(rows, cols, rules, "total_violations", "violating_records", "violation_rate")
    metrics = metrics.withColumn("business_rule_error", flag(F.col("violation_rate") > threshold))
    return metrics, _incidents(rows, cols, rules, all_rules)


# ---------------------------------------------------------------------- schema


def schema_rules(
    df: DataFrame,
    cols: Cols,
    enums: Mapping[str, Sequence[str]] | None = None,
    value_range: tuple[float, float] = (0.0, 100.0),
    severity: str = "warning",
) -> list[Rule]:
    """Null time, value missing or out of range, and one rule per category column that exists.

    Categories are compared trimmed and without regard to case; a missing category is allowed.
    """
    v = number(cols.value)
    note = F.lit("schema_violation")
    rules = [
        Rule("schema_null_timestamp", "null_timestamp_count", F.col(cols.ts).isNull(), severity, note),
        Rule(
            "schema_out_of_range",
            "out_of_range_count",
            v.isNull() | ~v.between(*value_range),
            severity,
            note,
        ),
    ]
    for column, allowed in (enums or {}).items():
        if column in df.columns and allowed:
            short = {"tariff_type": "tariff", "acorn_group": "acorn"}.get(column, column)
            names = [a.strip().upper() for a in allowed]
            bad = F.col(column).isNotNull() & ~F.upper(F.trim(column)).isin(names)
            rules.append(Rule(f"schema_invalid_{short}", f"invalid_{short}_count", bad, severity, note))
    return rules


def schema_validity(
    df: DataFrame,
    cols: Cols,
    enums: Mapping[str, Sequence[str]] | None = None,
    value_range: tuple[float, float] = (0.0, 100.0),
    all_rules: bool = False,
    severity: str = "warning",
) -> tuple[DataFrame, DataFrame]:
    rules = schema_rules(df, cols, enums, value_range, severity)
    metrics = _rule_metrics(df, cols, rules, "total_schema_errors", "invalid_records", "schema_error_rate")
    metrics = metrics.withColumn("schema_validity_score", 1 - F.col("schema_error_rate"))
    return metrics, _incidents(df, cols, rules, all_rules)


# ----------------------------------------------------------------------- fused


def all_metrics(
    df: DataFrame,
    cols: Cols,
    cfg: CheckSettings = CheckSettings(),
    rows_per_slice: int | None = None,
    rows: DataFrame | None = None,
) -> DataFrame:
    """All four metric sets per entity and day.

    Completeness, business and schema share one scan and one aggregate. Only the distinct times
    needed for the cadence check are shuffled by entity. The two results meet in one grouping.
    ``rows`` is ``with_entity_stats`` of the readings, if the caller has it already.
    """
    rows = with_entity_stats(df, cols) if rows is None else rows
    rules = business_rules(cols, cfg.min_value, cfg.max_value, cfg.z_score)
    shape = schema_rules(df, cols, cfg.enums, cfg.value_range)
    base = rows.groupBy(*cols.entity, day(cols.ts).alias(DAY)).agg(
        F.count(F.lit(1)).alias("actual_records"),
        _any_hit(rules).alias("violating_records"),
        _any_hit(shape).alias("invalid_records"),
        *[F.count_if(r.when).alias(r.count) for r in rules + shape],
    )
    flags = timeline_flags(df, cols, cfg.interval_minutes, cfg.tolerance_minutes, rows_per_slice)
    cadence = _temporal_metrics(df, flags, cols, cfg.anomaly_rate)
    expected = int(MINUTES_PER_DAY / cfg.interval_minutes)
    n = F.col("actual_records")
    return outer_merge([base, cadence], [*cols.entity, DAY]).withColumns(
        {
            "missing_rate": 1 - n / F.lit(float(expected)),
            "violation_rate": F.col("violating_records") / n,
            "schema_error_rate": F.col("invalid_records") / n,
            "schema_validity_score": 1 - F.col("invalid_records") / n,
        }
    )


def all_incidents(
    df: DataFrame,
    cols: Cols,
    cfg: CheckSettings = CheckSettings(),
    all_rules: bool = False,
    rows_per_slice: int | None = None,
    rows: DataFrame | None = None,
) -> DataFrame:
    """The incidents of the four checks in one table.

    Value and schema rules are judged in the same pass, and all hits share one grouping.
    """
    rows = with_entity_stats(df, cols) if rows is None else rows
    families = [
        business_rules(cols, cfg.min_value, cfg.max_value, cfg.z_score),
        schema_rules(df, cols, cfg.enums, cfg.value_range),
    ]
    flags = timeline_flags(df, cols, cfg.interval_minutes, cfg.tolerance_minutes, rows_per_slice)
    hits = _hits(rows, cols, families, all_rules).unionByName(_temporal_hits(flags, cols, all_rules))
    missing = completeness(df, cols, cfg.interval_minutes, cfg.daily_missing, critical=cfg.critical_missing)[1]
    return _one_per_rule(hits).unionByName(missing)


# ---------------------------------------------------------- weather consistency


def weather_consistency(
    df: DataFrame,
    cols: Cols,
    weather: str,
    min_pairs: int = 3,
    extreme_z: float = 2.0,
    response_z: float = 0.5,
) -> tuple[DataFrame, DataFrame]:
    """Does the value follow the weather?

    Metrics: correlation per entity and month. Incidents: days whose mean weather is far from the
    month's usual while the entity's mean value stays where it always is.
    """
    v, w = number(cols.value), number(weather)
    month = F.to_date(F.date_trunc("month", F.col(cols.ts))).alias("month")
    timed = df.filter(F.col(cols.ts).isNotNull())
    known = v.isNotNull() & w.isNotNull()
    pairs, x, y = F.count(F.when(known, 1)), F.when(known, v), F.when(known, w)
    # Not F.corr, which fails under ANSI when one side never changes.
    spread = F.stddev_samp(x) * F.stddev_samp(y)
    metrics = timed.groupBy(*cols.entity, month).agg(
        pairs.alias("pair_count"),
        F.when(pairs >= min_pairs, F.try_divide(F.covar_samp(x, y), spread)).alias("correlation"),
    )
    daily = timed.groupBy(*cols.entity, day(cols.ts).alias(DAY)).agg(F.avg(v).alias("_v"), F.avg(w).alias("_w"))
    by_month = [*cols.entity, "_month"]
    daily = daily.withColumn("_month", F.to_date(F.date_trunc("month", F.col(DAY))))
    # Day grain: at most one row per entity and day of the month reaches a group.
    usual = daily.groupBy(*by_month).agg(
        F.avg("_v").alias("_v_mean"),
        F.stddev_samp("_v").alias("_v_std"),
        F.avg("_w").alias("_w_mean"),
        F.stddev_samp("_w").alias("_w_std"),
    )
    joined = daily.join(usual, by_month)
    w_z = (F.col("_w") - F.col("_w_mean")) / F.nullif(F.col("_w_std"), F.lit(0.0))
    v_z = (F.col("_v") - F.col("_v_mean")) / F.nullif(F.col("_v_std"), F.lit(0.0))
    incidents = joined.filter((F.abs(w_z) > extreme_z) & (F.coalesce(F.abs(v_z), F.lit(0.0)) < response_z)).select(
        entity_id(cols.entity).alias("entity_id"),
        DAY,
        F.col(DAY).cast(df.schema[cols.ts].dataType).alias("incident_timestamp"),
        F.lit("business_weather_mismatch").alias("rule_name"),
        F.lit("warning").alias("severity"),
        F.concat_ws("|", w_z.cast("string"), F.coalesce(v_z, F.lit(0.0)).cast("string")).alias("evidence"),
    )
    return metrics, incidents


# --------------------------------------------------------------------- helpers


def _any_hit(rules: Sequence[Rule]) -> Column:
    """Rows that break at least one rule."""
    return F.count_if(reduce(or_, [r.when for r in rules]))


def _rule_metrics(
    df: DataFrame, cols: Cols, rules: Sequence[Rule], total: str, hit_rows: str, rate: str
) -> DataFrame:
    per_day = df.groupBy(*cols.entity, day(cols.ts).alias(DAY)).agg(
        F.count(F.lit(1)).alias("total_records"),
        _any_hit(rules).alias(hit_rows),
        *[F.count_if(r.when).alias(r.count) for r in rules],
    )
    return per_day.withColumns(
        {
            total: reduce(lambda a, b: a + b, [F.col(r.count) for r in rules]),
            rate: F.col(hit_rows) / F.col("total_records"),
        }
    )


def _incidents(df: DataFrame, cols: Cols, rules: Sequence[Rule], all_rules: bool) -> DataFrame:
    return _one_per_rule(_hits(df, cols, [rules], all_rules))


def _hits(df: DataFrame, cols: Cols, families: Sequence[Sequence[Rule]], all_rules: bool) -> DataFrame:
    """Rule hits as rows. By default a reading is reported under the first rule of each family it
    breaks; with ``all_rules`` under every one."""
    found = []
    for rules in families:
        each = [F.when(r.when, _hit(r)) for r in rules]
        found += each if all_rules else [F.coalesce(*each)]
    broken = reduce(or_, [F.coalesce(r.when, F.lit(False)) for rules in families for r in rules])
    hit = F.col("_hit")
    return (
        df.filter(broken)
        .withColumn("_hit", F.explode(F.filter(F.array(*found), lambda h: h.isNotNull())))
        .select(
            entity_id(cols.entity).alias("entity_id"),
            day(cols.ts).alias(DAY),
            F.col(cols.ts).alias("incident_timestamp"),
            *[hit[c].alias(c) for c in ("rule_name", "severity", "evidence")],
        )
    )


def _one_per_rule(hits: DataFrame) -> DataFrame:
    """One incident per entity, time and rule; copies are merged before they are shuffled."""
    return hits.groupBy(*INCIDENT_COLUMNS[:5]).agg(F.min("evidence").alias("evidence"))


def _hit(rule: Rule) -> Column:
    return F.struct(
        F.lit(rule.name).alias("rule_name"),
        F.lit(rule.severity).alias("severity"),
        rule.evidence.alias("evidence"),
    )
