"""Plain Parquet folders that a write can be repeated on.

The rows of a write belong to partitions (a streaming batch, a prediction day). A write replaces exactly the
partitions it has rows for, so the same batch or the same day written again leaves the same rows, after a crash
between write and checkpoint too, and no log has to be kept. Other partitions stay as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from sievewatt.runtime import counted


def replace_parts(df: DataFrame, path: str, parts: Sequence[str]) -> int:
    """Write ``df`` and return its number of rows; partitions of ``parts`` that it has no row for are left alone."""
    watched, seen = counted(df)
    watched.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)
    return int(seen.get["rows"])


def read_parts(spark: SparkSession, path: str) -> DataFrame:
    """All partitions; columns that only some writes had are null in the others."""
    return spark.read.option("mergeSchema", True).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Has any partition been written?"""
    parts = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/*=*")
    found = parts.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(parts)
    return bool(found) and len(found) > 0


def batch_name(writer: str, batch_id: int) -> str:
    """The partition of one micro-batch; writers with different names (checkpoints) can share a folder."""
    return f"stream-{hashlib.sha256(writer.encode()).hexdigest()[:12]}-{batch_id}"
