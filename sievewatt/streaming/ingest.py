"""File streams into the bronze layer, written once however often a batch is replayed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sievewatt.functions.columns import parse_time
from sievewatt.sources import sinks
from sievewatt.sources.raw import READING_SCHEMA, WEATHER_HOURLY_NUMBERS, WEATHER_HOURLY_TEXTS, select_readings

WEATHER_STREAM_SCHEMA = T.StructType(
    [T.StructField("time", T.StringType())]
    + [T.StructField(c, T.DoubleType()) for c in WEATHER_HOURLY_NUMBERS]
    + [T.StructField(c, T.StringType()) for c in WEATHER_HOURLY_TEXTS]
)


def stream_readings(spark: SparkSession, folder: str, max_files: int = 100) -> DataFrame:
    """New reading files in a folder, typed exactly as the batch reader types them."""
    text = _csv_stream(spark, folder, READING_SCHEMA, max_files).withColumn("_file", F.col("_metadata.file_name"))
    block = F.regexp_replace(F.regexp_replace("_file", r"\.csv$", ""), "^block_", "")
    return select_readings(text).withColumn("source_block", block).drop("_file")


def stream_weather(spark: SparkSession, folder: str, max_files: int = 100) -> DataFrame:
    df = _csv_stream(spark, folder, WEATHER_STREAM_SCHEMA, max_files)
    return df.select(
        parse_time("time").alias("timestamp"),
        *[F.col(s).alias(t) for s, t in WEATHER_HOURLY_NUMBERS.items()],
        *[F.col(s).alias(t) for s, t in WEATHER_HOURLY_TEXTS.items()],
    )


def _csv_stream(spark: SparkSession, folder: str, schema: T.StructType, max_files: int) -> DataFrame:
    return (
        spark.readStream.option("header", True)
        .option("maxFilesPerTrigger", max_files)
        .option("pathGlobFilter", "*.csv")
        # a file whose header names other columns, or the same in another order, is an error
        .option("enforceSchema", False)
        .schema(schema)
        .csv(folder)
    )


def with_stream_metadata(df: DataFrame, source: str, batch: str) -> DataFrame:
    """The columns the batch path adds, so that both have one bronze schema."""
    return df.withColumns(
        {
            "_ingestion_timestamp": F.current_timestamp(),
            "_source": F.lit(source),
            "_batch_id": F.lit(batch),
        }
    )


def write_stream(
    df: DataFrame,
    folder: str,
    checkpoint: str,
    source: str = "halfhourly_streaming",
    trigger: str | None = "30 seconds",
    writer: str | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    output_mode: str = "append",
) -> StreamingQuery:
    """Write every micro-batch into its own partition ``_batch_id`` of a Parquet folder.

    A batch that is run again after a crash between write and checkpoint replaces its own partition. ``writer``
    names the partitions, must stay the same across restarts and defaults to the checkpoint folder.
    ``trigger=None`` processes what is there and stops.
    """
    name = writer or checkpoint

    def save(batch: DataFrame, batch_id: int) -> None:
        rows = transform(batch) if transform else batch
        sinks.replace_parts(with_stream_metadata(rows, source, sinks.batch_name(name, batch_id)), folder, ["_batch_id"])

    out = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint).foreachBatch(save)
    out = out.trigger(availableNow=True) if trigger is None else out.trigger(processingTime=trigger)
    return out.start()
