"""The audit log: one typed row per run."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewatt.sources import tables

AUDIT_SCHEMA = """
    pipeline_name string, run_timestamp timestamp, status string, error_message string,
    config_snapshot string, input_versions map<string,bigint>, output_paths map<string,string>,
    row_counts map<string,bigint>, rejected_rows bigint, quality_score_summary map<string,double>,
    output_versions map<string,bigint>,
    lineage array<struct<target:string,target_version:bigint,source:string,source_version:bigint>>
"""

# How a run can end.
STATUSES = ("SUCCESS", "FAILED", "PARTIAL")


def log_run(
    spark: SparkSession,
    path: str,
    pipeline_name: str,
    config: Any = None,
    input_versions: Mapping[str, int] | None = None,
    output_paths: Mapping[str, str] | None = None,
    row_counts: Mapping[str, int] | None = None,
    rejected_rows: int = 0,
    quality_score_summary: Mapping[str, float] | None = None,
    status: str = "SUCCESS",
    error_message: str | None = None,
    run_timestamp: datetime | None = None,
    output_versions: Mapping[str, int] | None = None,
    lineage: Sequence[tuple[str, int | None, str, int | None]] = (),
) -> int:
    """Append one run to the log, creating it if needed.

    ``input_versions`` are versions of tables that the run read, ``output_versions`` those it wrote. ``lineage`` has a
    (target, its version, source, its version) for everything a table was made of; files have no version. A log of
    before these columns gets them.
    """
    if status not in STATUSES:
        raise ValueError(f"unknown status {status!r}")
    row = (
        pipeline_name,
        run_timestamp or datetime.now(timezone.utc),
        status,
        error_message,
        json.dumps(config if config is not None else {}, default=str),
        dict(input_versions or {}),
        dict(output_paths or {}),
        dict(row_counts or {}),
        int(rejected_rows),
        {k: float(v) for k, v in (quality_score_summary or {}).items()},
        dict(output_versions or {}),
        list(lineage),
    )
    return tables.write(spark.createDataFrame([row], AUDIT_SCHEMA), path, mode="append", merge=True, operation="audit")


def query_runs(
    spark: SparkSession,
    path: str,
    pipeline_name: str | None = None,
    status: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Runs by name and status, newest first."""
    runs = tables.read(spark, path)
    if pipeline_name:
        runs = runs.filter(F.col("pipeline_name") == pipeline_name)
    if status:
        runs = runs.filter(F.col("status") == status)
    found = runs.orderBy(F.col("run_timestamp").desc(), "pipeline_name")
    return found if limit is None else found.limit(limit)


def row_count(spark: SparkSession, path: str) -> int:
    """Rows of a table; 0 if it does not exist."""
    return tables.read(spark, path).count() if tables.exists(spark, path) else 0


def table_version(spark: SparkSession, path: str) -> int:
    """Latest version; 0 if the table does not exist."""
    return tables.latest(spark, path) or 0


def apply_retention(spark: SparkSession, path: str, days: int = 365, now: datetime | None = None) -> int:
    return tables.drop_older(spark, path, "run_timestamp", days, now)
