"""Schema evolution, comparison and validation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Numeric types from narrow to wide.
NUMERIC_ORDER = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType()]


def wider_type(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The type that holds every value of both, or None if there is none."""
    if a == b:
        return a
    if a in NUMERIC_ORDER and b in NUMERIC_ORDER:
        narrow, wide = sorted((a, b), key=NUMERIC_ORDER.index)
        if isinstance(wide, (T.FloatType, T.DoubleType)) and not isinstance(narrow, T.FloatType):
            # Not every long is a double; smaller whole numbers are.
            return None if isinstance(narrow, T.LongType) else T.DoubleType()
        return wide
    if {type(a), type(b)} == {T.DateType, T.TimestampType}:
        return T.TimestampType()
    if {type(a), type(b)} == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    return None


def evolve(df: DataFrame, path: str, mode: str = "merge", allow_new: bool = True) -> int:
    """Write ``df`` to a table whose schema may differ; returns the version written.

    ``merge`` appends, adding columns and widening types. ``fail`` appends only if nothing was
    removed or retyped (and, unless ``allow_new``, nothing added). ``overwrite`` replaces the table.
    """
    from sievewatt.sources import tables

    if mode not in ("merge", "fail", "overwrite"):
        raise ValueError(f"unknown mode {mode!r}")
    spark = df.sparkSession
    if mode == "overwrite" or not tables.exists(spark, path):
        return tables.write(df, path, operation="evolve")
    old = {f.name: f.dataType for f in tables.read(spark, path).schema.fields}
    new = {f.name: f.dataType for f in df.schema.fields}
    removed, added = sorted(old.keys() - new.keys()), sorted(new.keys() - old.keys())
    retyped = sorted(n for n in old.keys() & new.keys() if old[n] != new[n])
    if mode == "fail":
        if removed:
            raise ValueError(f"columns removed: {removed}")
        if retyped:
            raise ValueError(f"column types changed: {retyped}")
    if added and not allow_new:
        raise ValueError(f"new columns: {added}")
    return tables.write(df, path, mode="append", merge=True, operation="evolve")


def schema_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """(column, status, type_1, type_2) for every column of either table."""
    one = {f.name: f.dataType.simpleString() for f in a.schema.fields}
    two = {f.name: f.dataType.simpleString() for f in b.schema.fields}
    rows = []
    for name in sorted(one.keys() | two.keys()):
        left, right = one.get(name), two.get(name)
        if right is None:
            status = "only_in_table1"
        elif left is None:
            status = "only_in_table2"
        else:
            status = "same" if left == right else "type_differs"
        rows.append((name, status, left, right))
    return a.sparkSession.createDataFrame(rows, "column string, status string, type_1 string, type_2 string")


def table_diff(spark: SparkSession, path1: str, path2: str) -> DataFrame:
    from sievewatt.sources import tables

    return schema_diff(tables.read(spark, path1), tables.read(spark, path2))


def schema_matches(df: DataFrame, expected: T.StructType) -> bool:
    """Same names, types and nullability in the same order."""
    return [(f.name, f.dataType, f.nullable) for f in df.schema.fields] == [
        (f.name, f.dataType, f.nullable) for f in expected.fields
    ]
