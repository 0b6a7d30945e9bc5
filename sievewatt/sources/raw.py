"""Readers for the raw files. Schemas are declared, never inferred, and every reader is lazy."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievewatt.functions.columns import parse_day, parse_number, parse_time

# Source column -> our column.
HOUSEHOLD_COLUMNS = {
    "LCLid": "household_id",
    "stdorToU": "tariff_type",
    "Acorn": "acorn_code",
    "Acorn_grouped": "acorn_group",
    "file": "source_block",
}
READING_COLUMNS = ["LCLid", "tstp", "energy(kWh/hh)"]
WEATHER_HOURLY_NUMBERS = {
    "temperature": "temperature_celsius",
    "apparentTemperature": "apparent_temperature_celsius",
    "humidity": "humidity_ratio",
    "pressure": "pressure_mb",
    "windSpeed": "wind_speed_ms",
    "windBearing": "wind_bearing_degrees",
    "visibility": "visibility_km",
    "dewPoint": "dew_point_celsius",
}
WEATHER_HOURLY_TEXTS = {"precipType": "precipitation_type", "icon": "weather_icon", "summary": "weather_summary"}
WEATHER_DAILY_NUMBERS = {
    "temperatureHigh": "temp_high_celsius",
    "temperatureLow": "temp_low_celsius",
    "temperatureMin": "temp_min_celsius",
    "temperatureMax": "temp_max_celsius",
    "precipIntensity": "precipitation_intensity_mmh",
    "precipProbability": "precipitation_probability",
    "humidity": "humidity_ratio",
    "pressure": "pressure_mb",
    "windSpeed": "wind_speed_ms",
    "windGust": "wind_gust_ms",
    "visibility": "visibility_km",
}
WEATHER_DAILY_TEXTS = {"summary": "weather_summary"}
DAILY_NUMBERS = {
    "energy_median": "energy_median_kwh",
    "energy_mean": "energy_mean_kwh",
    "energy_max": "energy_max_kwh",
    "energy_count": "energy_count",
    "energy_std": "energy_std_kwh",
    "energy_sum": "energy_sum_kwh",
    "energy_min": "energy_min_kwh",
}
# Fixed value: characters a column name may not contain.
BAD_NAME_CHARS = r"[ ,;{}()\n\t=/\\]"

BLOCK_GLOB = "block_*.csv"

# Blocks of this size on average get a folder each in a table; of smaller ones many share a file.
FOLDER_BYTES = 16 * 1024 * 1024

READING_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in READING_COLUMNS])
READING_OUT = "household_id string, timestamp timestamp, energy_kwh double, source_block string"
HOLIDAY_OUT = "holiday_date date"


def with_ingest_metadata(df: DataFrame, source: str, batch_id: str | None = None) -> DataFrame:
    """When, from where and in which run a row came in. ``_batch_id`` is one string per run."""
    run = F.lit(batch_id) if batch_id is not None else F.date_format(F.current_timestamp(), "yyyyMMddHHmmssSSS")
    return df.withColumns(
        {"_ingestion_timestamp": F.current_timestamp(), "_source": F.lit(source), "_batch_id": run.cast("string")}
    )


def read_households(spark: SparkSession, path: str) -> DataFrame:
    df = _csv(spark, path)
    return df.select(*[F.col(f"`{s}`").alias(t) for s, t in HOUSEHOLD_COLUMNS.items()])


def read_readings(spark: SparkSession, folder: str, limit_blocks: int | None = None) -> DataFrame:
    """All ``block_*.csv`` of a folder as one scan; ``source_block`` comes from the file name.

    With ``limit_blocks`` the first files by name are read (in text order, so 10 precedes 2).
    """
    text = _blocks(spark, folder, READING_SCHEMA, limit_blocks)
    return select_readings(text).withColumn("source_block", _block_name()).drop("_file")


def select_readings(text: DataFrame) -> DataFrame:
    """Raw text columns to typed ones; shared by the batch and the streaming reader."""
    return text.select(
        F.col("LCLid").alias("household_id"),
        parse_time("tstp").alias("timestamp"),
        parse_number("`energy(kWh/hh)`").alias("energy_kwh"),
        *([F.col("_file")] if "_file" in text.columns else []),
    )


def read_daily(spark: SparkSession, folder: str, limit_blocks: int | None = None) -> DataFrame:
    """Daily consumption blocks."""
    names = ["LCLid", "day", *DAILY_NUMBERS]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    text = _blocks(spark, folder, schema, limit_blocks)
    return text.select(
        F.col("LCLid").alias("household_id"),
        parse_day("day").alias("date"),
        *[parse_number(s).alias(t) for s, t in DAILY_NUMBERS.items()],
        "_file",
    ).withColumn("source_block", _block_name()).drop("_file")


def read_weather_hourly(spark: SparkSession, path: str) -> DataFrame:
    df = _csv(spark, path)
    return df.select(
        parse_time("time").alias("timestamp"),
        *[parse_number(s).alias(t) for s, t in WEATHER_HOURLY_NUMBERS.items()],
        *[F.col(s).alias(t) for s, t in WEATHER_HOURLY_TEXTS.items()],
    )


def read_weather_daily(spark: SparkSession, path: str) -> DataFrame:
    """Only the measures the file has; all of them are optional."""
    df = _csv(spark, path)
    numbers = [parse_number(s).alias(t) for s, t in WEATHER_DAILY_NUMBERS.items() if s in df.columns]
    texts = [F.col(s).alias(t) for s, t in WEATHER_DAILY_TEXTS.items() if s in df.columns]
    return df.select(parse_time("time").cast("date").alias("date"), *numbers, *texts)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """Free column names, made safe; names that become equal get a number."""
    df = _csv(spark, path)
    return df.toDF(*safe_names(df.columns))


def safe_names(names: Sequence[str]) -> list[str]:
    out: list[str] = []
    for name in names:
        safe = re.sub(BAD_NAME_CHARS, "_", name)
        candidate, n = safe, 1
        while candidate in out:
            n += 1
            candidate = f"{safe}_{n}"
        out.append(candidate)
    return out


def read_holidays(spark: SparkSession, path: str) -> DataFrame:
    df = _csv(spark, path)
    if "Bank holidays" in df.columns:
        df = df.withColumnRenamed("Bank holidays", "holiday_date")
    return df.withColumn("holiday_date", parse_day("holiday_date"))


def read_optional(reader: Callable[[], DataFrame], spark: SparkSession, schema: str | T.StructType) -> DataFrame:
    """What the reader finds, or an empty frame of that schema if the path does not exist."""
    try:
        return reader()
    except AnalysisException as err:
        if "PATH_NOT_FOUND" in str(err):
            return spark.createDataFrame([], schema)
        raise


def _csv(spark: SparkSession, path: str) -> DataFrame:
    """Every column as text, named by the header; typing is explicit in the readers."""
    return spark.read.option("header", True).option("mode", "PERMISSIVE").csv(path)


def _blocks(spark: SparkSession, folder: str, schema: T.StructType, limit: int | None) -> DataFrame:
    reader = spark.read.option("header", True).schema(schema)
    try:
        everything = reader.option("pathGlobFilter", BLOCK_GLOB).csv(folder)
        files = sorted(everything.inputFiles(), key=_base_name)
    except AnalysisException as err:
        if "PATH_NOT_FOUND" not in str(err):
            raise
        files = []
    if not files:
        raise ValueError(f"no {BLOCK_GLOB} in {folder}")
    if limit is not None and limit < len(files):
        everything = reader.csv(files[:limit])
    return everything.withColumn("_file", F.col("_metadata.file_name"))


def _block_name() -> Column:
    return F.regexp_extract("_file", r"^block_(.*)\.csv$", 1)


def fills_folders(spark: SparkSession, folder: str) -> bool:
    """Are the blocks of a folder large enough, on average, for a folder per block in the table made of them?"""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    held = path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path)
    return held.getLength() >= FOLDER_BYTES * held.getFileCount()


def _base_name(uri: str) -> str:
    return uri.rsplit("/", 1)[-1]
