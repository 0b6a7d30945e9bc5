"""Versioned Parquet tables.

A table is a folder of snapshots and a small log with one file per version. A write first saves its
snapshot and then publishes its log file by an atomic rename, so a writer that dies leaves nothing a
reader would see, and two writers cannot publish the same version. Readers trust only the log.

    <path>/data/snapshot=<name>/...parquet
    <path>/log/<version>.json

A log row names the snapshot it added and the version it builds on (none for an overwrite), so the
log grows by one short row per write however long a table lives.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Sequence
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievewatt.governance.schema import wider_type
from sievewatt.runtime import counted, plan_bytes

LOG_SCHEMA = """
    version bigint, parent bigint, snapshot string, written_us bigint, operation string,
    table_schema string, snapshot_schema string, partition_by array<string>,
    rows_written bigint, writer string, batch_id bigint
"""

# Target size of one file after compaction.
FILE_BYTES = 256 * 1024 * 1024


class TableMissing(ValueError):
    """No table has been written at this path, or not that version of it."""


def log(spark: SparkSession, path: str) -> DataFrame | None:
    """The table's log, or None if there is no table."""
    return spark.read.schema(LOG_SCHEMA).json(f"{path}/log") if exists(spark, path) else None


def exists(spark: SparkSession, path: str) -> bool:
    """Asks the file system that owns the path, wherever that is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/log")
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def latest(spark: SparkSession, path: str) -> int | None:
    """The newest version number, or None if there is no table."""
    rows = log(spark, path)
    return None if rows is None else rows.agg(F.max("version")).first()[0]


def history(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """(version, timestamp, operation, rows_written), newest first; empty if there is no table."""
    rows = log(spark, path)
    if rows is None:
        return spark.createDataFrame([], "version bigint, timestamp timestamp, operation string, rows_written bigint")
    at = F.timestamp_micros("written_us").alias("timestamp")
    found = rows.select("version", at, "operation", "rows_written").orderBy(F.col("version").desc())
    return found if limit is None else found.limit(limit)


def rows_written(spark: SparkSession, path: str) -> int:
    """Rows the newest version added, as counted while it was written."""
    return _versions(spark, path)[latest(spark, path)]["rows_written"]


def read(
    spark: SparkSession, path: str, version: int | None = None, as_of: datetime | str | None = None
) -> DataFrame:
    """The table now, at a version, or at a moment."""
    rows = _versions(spark, path, as_of)
    number = max(rows, default=None) if version is None else version
    if number not in rows:
        raise TableMissing(f"no table {path} at {version if version is not None else as_of or 'all'}")
    schema = _schema(rows[number]["table_schema"])
    groups: dict[tuple, list[str]] = {}
    for row in _content(rows, number):
        groups.setdefault((row["snapshot_schema"], tuple(row["partition_by"] or ())), []).append(row["snapshot"])
    # Snapshots of one shape, the usual case, are one scan.
    frames = [_scan(spark, path, names, _schema(own), schema) for (own, _), names in groups.items()]
    return reduce(lambda a, b: a.unionByName(b), frames)


def write(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    merge: bool = False,
    partition_by: Sequence[str] = (),
    operation: str | None = None,
    writer: str | None = None,
    batch_id: int | None = None,
    must_match: bool = False,
) -> int:
    """Save ``df`` as the next version and return its number.

    ``overwrite`` replaces the content (with ``must_match`` only if the columns stay the same),
    ``append`` adds to it. Without ``merge`` an append must have the table's columns; with it, new
    columns are added and types widened. A streaming batch passes ``writer`` and ``batch_id``: a
    batch that is already in the log is not written again.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError(f"unknown mode {mode!r}")
    spark = df.sparkSession
    rows = _versions(spark, path)
    if writer is not None:
        for row in rows.values():
            if row["writer"] == writer and row["batch_id"] == batch_id:
                return row["version"]
    before = max(rows, default=None)
    schema, parent = df.schema, None
    if before is not None and (mode == "append" or must_match):
        old = _schema(rows[before]["table_schema"])
        schema = _append_schema(old, df.schema, merge and not must_match)
        parent = before if mode == "append" else None
    number = 0 if before is None else before + 1
    name = f"{number:010d}-{uuid.uuid4().hex}"
    watched, seen = counted(df)
    out = watched.write.mode("errorifexists")
    if partition_by:
        out = out.partitionBy(*partition_by)
    out.parquet(f"{path}/data/snapshot={name}")
    _publish(
        spark,
        path,
        version=number,
        parent=parent,
        snapshot=name,
        operation=operation or mode,
        table_schema=schema.json(),
        snapshot_schema=df.schema.json(),
        partition_by=list(partition_by),
        rows_written=seen.get["rows"],
        writer=writer,
        batch_id=batch_id,
    )
    return number


def restore(spark: SparkSession, path: str, version: int, target: str | None = None) -> int:
    """Make an old version current again, as a new version here or in another table.

    Within the same table only the log grows; the snapshots are already there.
    """
    if target is not None and target != path:
        return write(read(spark, path, version), target, operation="restore")
    rows = _versions(spark, path)
    if version not in rows:
        raise TableMissing(f"no table {path} at {version}")
    number = max(rows) + 1
    old = rows[version]
    _publish(
        spark, path, version=number, parent=version, operation="restore", table_schema=old["table_schema"], rows_written=0
    )
    return number


def compare(spark: SparkSession, path: str, version1: int, version2: int, keys: Sequence[str] = ()) -> DataFrame:
    """One row: counts, their difference, equal schema; with ``keys`` also row-level differences."""
    one, two = read(spark, path, version1), read(spark, path, version2)
    equal = one.schema == two.schema
    if keys:
        counts = _row_differences(one, two, keys)
    else:
        sides = one.select(F.lit(1).alias("side")).unionByName(two.select(F.lit(2).alias("side")))
        counts = sides.agg(*[F.count(F.when(F.col("side") == s, 1)).alias(f"count_v{s}") for s in (1, 2)])
    return counts.select(
        F.lit(version1).cast("long").alias("version1"),
        F.lit(version2).cast("long").alias("version2"),
        "count_v1",
        "count_v2",
        (F.col("count_v2") - F.col("count_v1")).alias("row_diff"),
        F.lit(equal).alias("schema_equal"),
        *(["added", "removed", "changed"] if keys else []),
    )


def _row_differences(one: DataFrame, two: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Compare by key. Both sides shrink to a hash per row before they meet in one grouping."""
    shared = [c for c in one.columns if c in two.columns and c not in keys]

    def side(df: DataFrame, which: int) -> DataFrame:
        digest = F.xxhash64(*[F.col(c) for c in shared]) if shared else F.lit(0).cast("long")
        return df.select(*keys, F.lit(which).alias("side"), digest.cast("decimal(38,0)").alias("h"))

    sums = []
    for s in (1, 2):
        here = F.col("side") == s
        sums += [F.count(F.when(here, 1)).alias(f"n{s}"), F.sum(F.when(here, F.col("h"))).alias(f"h{s}")]
    per_key = side(one, 1).unionByName(side(two, 2)).groupBy(*keys).agg(*sums)
    both = (F.col("n1") > 0) & (F.col("n2") > 0)
    changed = both & ((F.col("n1") != F.col("n2")) | (F.col("h1") != F.col("h2")))
    zero = F.lit(0).cast("long")
    return per_key.agg(
        F.coalesce(F.sum("n1"), zero).alias("count_v1"),
        F.coalesce(F.sum("n2"), zero).alias("count_v2"),
        F.count(F.when(F.col("n1") == 0, 1)).alias("added"),
        F.count(F.when(F.col("n2") == 0, 1)).alias("removed"),
        F.count(F.when(changed, 1)).alias("changed"),
    )


def vacuum(spark: SparkSession, path: str, hours: float = 168, dry_run: bool = False) -> list[str]:
    """Drop snapshots that no version younger than ``hours`` uses; returns their names.

    The current version is always kept. Older versions that lose a snapshot can no longer be read.
    """
    rows = _versions(spark, path)
    if not rows:
        return []
    cutoff = _micros(datetime.now(timezone.utc) - timedelta(hours=hours))
    kept = {n for n, row in rows.items() if row["written_us"] >= cutoff or n == max(rows)}
    live = {row["snapshot"] for n in kept for row in _content(rows, n)}
    expired = sorted(row["snapshot"] for row in rows.values() if row["snapshot"] and row["snapshot"] not in live)
    if not dry_run:
        for name in expired:
            folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/data/snapshot={name}")
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return expired


def optimize(spark: SparkSession, path: str, zorder: Sequence[str] = (), files: int | None = None) -> int:
    """Rewrite the table into fewer, larger files, optionally clustered by several columns at once."""
    df = read(spark, path)
    count = files or max(1, -(-plan_bytes(df) // FILE_BYTES))
    if zorder:
        keyed = df.withColumn("_z", zorder_key(df, zorder))
        packed = keyed.repartitionByRange(count, "_z").sortWithinPartitions("_z").drop("_z")
    else:
        packed = df.repartition(count)
    return write(packed, path, operation="optimize")


def zorder_key(df: DataFrame, columns: Sequence[str], bits: int = 8) -> Column:
    """Interleave the leading bits of each column's place in its own distribution.

    Places are counted against approximate quantiles of the column, so that skewed columns spread
    evenly too. All quantiles come from one aggregate; 2^bits - 1 numbers per column reach the driver.
    """
    bits = min(bits, 62 // len(columns))  # the key is a long
    probs = [i / 2**bits for i in range(1, 2**bits)]
    numeric = {c: _as_number(df, c) for c in columns}
    cuts = df.agg(*[F.percentile_approx(v, probs, 10000).alias(c) for c, v in numeric.items()]).first()
    key = F.lit(0).cast("long")
    for i, c in enumerate(columns):
        edges = sorted(set(cuts[c] or []))
        place = F.lit(0)
        if edges:
            listed = F.array(*[F.lit(float(e)) for e in edges])
            place = F.size(F.filter(listed, lambda e, v=numeric[c]: e <= v))
        for bit in range(bits):
            one = F.shiftright(place, bit).bitwiseAND(1).cast("long")
            key = key.bitwiseOR(F.shiftleft(one, bit * len(columns) + i))
    return key


def drop_older(spark: SparkSession, path: str, ts: str, days: int, now: datetime | None = None) -> int:
    """Retention by age: keep rows younger than ``days`` and write them as a new version."""
    cutoff = (now or datetime.now(timezone.utc)) - timedelta(days=days)
    kept = read(spark, path).filter(F.col(ts) >= F.lit(cutoff))
    return write(kept, path, operation="retention")


# --------------------------------------------------------------------- helpers


def _versions(spark: SparkSession, path: str, as_of: datetime | str | None = None) -> dict[int, Row]:
    """The log rows by version number: one short row per write, so small enough for the driver."""
    rows = log(spark, path)
    if rows is None:
        return {}
    if as_of is not None:
        rows = rows.filter(F.timestamp_micros("written_us") <= F.lit(as_of).cast("timestamp"))
    return {row["version"]: row for row in rows.collect()}


def _content(rows: dict[int, Row], version: int) -> list[Row]:
    """The rows whose snapshots make up a version, oldest first."""
    found = []
    at: int | None = version
    while at is not None:
        if rows[at]["snapshot"]:
            found.append(rows[at])
        at = rows[at]["parent"]
    return found[::-1]


def _publish(spark: SparkSession, path: str, **entry) -> None:
    """Write the log file aside and rename it into place; fails if that version already exists."""
    entry["written_us"] = _micros(datetime.now(timezone.utc))
    fs = spark._jvm.org.apache.hadoop.fs
    final = fs.Path(f"{path}/log/{entry['version']:010d}.json")
    draft = fs.Path(f"{path}/log/_{uuid.uuid4().hex}")
    conf = spark._jsc.hadoopConfiguration()
    out = final.getFileSystem(conf).create(draft)
    out.write(bytearray(json.dumps(entry), "utf-8"))
    out.close()
    no_overwrite = spark.sparkContext._gateway.new_array(fs.Options.Rename, 0)
    fs.FileContext.getFileContext(final.getFileSystem(conf).getUri(), conf).rename(draft, final, no_overwrite)


def _scan(spark, path, names, own: T.StructType, schema: T.StructType) -> DataFrame:
    folders = [f"{path}/data/snapshot={n}" for n in names]
    df = spark.read.schema(own).option("basePath", f"{path}/data").parquet(*folders)
    return df.select(*[_lined_up(own, f) for f in schema.fields])


def _lined_up(own: T.StructType, field: T.StructField) -> Column:
    if field.name not in own.names:
        return F.lit(None).cast(field.dataType).alias(field.name)
    column = F.col(f"`{field.name}`")
    if own[field.name].dataType != field.dataType:
        column = column.cast(field.dataType)
    return column.alias(field.name)


def _append_schema(old: T.StructType, new: T.StructType, merge: bool) -> T.StructType:
    old_by, new_by = {f.name: f for f in old.fields}, {f.name: f for f in new.fields}
    if not merge:
        same = old_by.keys() == new_by.keys() and all(
            wider_type(old_by[n].dataType, new_by[n].dataType) == old_by[n].dataType for n in old_by
        )
        if not same:
            raise ValueError("columns differ from the table's; pass merge=True to evolve it")
        return old
    fields = []
    for name, field in old_by.items():
        dtype = field.dataType
        if name in new_by:
            dtype = wider_type(dtype, new_by[name].dataType)
            if dtype is None:
                raise ValueError(f"column {name} cannot be widened to {new_by[name].dataType.simpleString()}")
        fields.append(T.StructField(name, dtype, True))
    fields += [T.StructField(n, f.dataType, True) for n, f in new_by.items() if n not in old_by]
    return T.StructType(fields)


def _as_number(df: DataFrame, name: str) -> Column:
    dtype = df.schema[name].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_micros(F.col(name).cast("timestamp")).cast("double")
    if isinstance(dtype, T.StringType):
        # Six bytes keep the alphabetical order and fit a double exactly; what all values start with is left out.
        ends = df.agg(F.hex(F.min(name)), F.hex(F.max(name))).first()
        same = len(os.path.commonprefix([e or "" for e in ends])) // 2 * 2
        return F.conv(F.rpad(F.substring(F.hex(name), same + 1, 12), 12, "0"), 16, 10).cast("double")
    return F.col(name).cast("double")


def _schema(text: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(text))


def _micros(at: datetime) -> int:
    return int(at.timestamp() * 1_000_000)
