"""Session builder. The operators themselves work on any session."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app_name: str = "sievewatt", master: str | None = None, **conf: str) -> SparkSession:
    """UTC, ANSI on, adaptive execution with skew handling.

    Shuffle partitions are left to the cluster's own settings and AQE coalescing unless given in
    ``conf`` (keys use ``__`` for ``.``, e.g. ``spark__sql__shuffle__partitions="8"``).
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Steps of a layer run that do not need each other share the executors.
        .config("spark.scheduler.mode", "FAIR")
        # Without this every Column call also sends its Python line number to the JVM.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, val in conf.items():
        builder = builder.config(key.replace("__", "."), val)
    return builder.getOrCreate()
