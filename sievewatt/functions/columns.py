"""Scalar expressions: cleaning, calendar parts, categories."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Score categories from best to worst, by lowest score.
SCORE_CATEGORIES = [("excellent", 90.0), ("good", 80.0), ("fair", 70.0)]
LOWEST_CATEGORY = "poor"

# Risk categories by the risk score they stop at.
RISK_CATEGORIES = [("low", 0.3), ("medium", 0.7)]
HIGHEST_RISK = "high"

# Fixed value: how raw files write a reading's time.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

MINUTES_PER_DAY = 24 * 60


def parse_time(c: str | Column) -> Column:
    """Drop a run of zero fractions, then parse; text that is no time becomes null."""
    text = F.regexp_replace(F.trim(_col(c)), r"\.0+$", "")
    return F.try_to_timestamp(text, F.lit(TIME_FORMAT))


def parse_day(c: str | Column) -> Column:
    return F.try_to_timestamp(F.trim(_col(c)), F.lit("yyyy-MM-dd")).cast("date")


def parse_number(c: str | Column) -> Column:
    """Trim and read as double; text that is no number becomes null."""
    return F.trim(_col(c)).try_cast("double")


def number(c: str | Column) -> Column:
    """The value with NaN read as missing."""
    return F.nanvl(_col(c).cast("double"), F.lit(None).cast("double"))


def minutes_between(later: Column, earlier: Column) -> Column:
    return (micros(later) - micros(earlier)) / F.lit(60_000_000.0)


def micros(c: str | Column) -> Column:
    """Microseconds since the epoch, for timestamps with or without a zone (session zone UTC)."""
    return F.unix_micros(_col(c).cast("timestamp"))


def day(c: str | Column) -> Column:
    return F.to_date(_col(c))


def day_number(c: str | Column) -> Column:
    """Days since the epoch, so that a range frame can count days."""
    return F.unix_date(_col(c))


def calendar_parts(ts: str | Column) -> dict[str, Column]:
    """date, hour, weekday (1 = Sunday), day of month, month, year."""
    c = _col(ts)
    return {
        "date": F.to_date(c),
        "hour": F.hour(c),
        "day_of_week": F.dayofweek(c),
        "day_of_month": F.dayofmonth(c),
        "month": F.month(c),
        "year": F.year(c),
    }


def entity_id(entity: tuple[str, ...] | list[str]) -> Column:
    return F.concat_ws("_", *[F.col(c).cast("string") for c in entity])


def score_category(score: Column) -> Column:
    (name, floor), *rest = SCORE_CATEGORIES
    out = F.when(score >= floor, name)
    for name, floor in rest:
        out = out.when(score >= floor, name)
    return out.otherwise(LOWEST_CATEGORY)


def risk_category(score: Column) -> Column:
    (name, stop), *rest = RISK_CATEGORIES
    out = F.when(score < stop, name)
    for name, stop in rest:
        out = out.when(score < stop, name)
    return out.otherwise(HIGHEST_RISK)


def flag(cond: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.coalesce(cond.cast("int"), F.lit(0))


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c
