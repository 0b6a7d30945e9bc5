"""Declarative checks on a table, all answered by one pass over it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievewatt.config import CheckSettings, Cols
from sievewatt.functions.columns import flag

RESULT_SCHEMA = T.StructType(
    [
        T.StructField("expectation", T.StringType()),
        T.StructField("column", T.StringType()),
        T.StructField("success", T.BooleanType()),
        T.StructField("unexpected_count", T.LongType()),
        T.StructField("total", T.LongType()),
    ]
)

# Type names users of the dataframe world write, and Spark's names for them.
TYPE_NAMES = {"float64": "double", "int64": "bigint", "int32": "int", "str": "string", "bool": "boolean"}


@dataclass(frozen=True)
class Expectation:
    kind: str
    columns: tuple[str, ...]
    args: dict[str, Any] = field(default_factory=dict)

    @property
    def label(self) -> str:
        return ",".join(self.columns)


def exists(column: str) -> Expectation:
    return Expectation("column_exists", (column,))


def not_null(column: str) -> Expectation:
    return Expectation("not_null", (column,))


def between(column: str, low: float, high: float) -> Expectation:
    return Expectation("between", (column,), {"low": low, "high": high})


def in_set(column: str, allowed: Sequence[Any]) -> Expectation:
    return Expectation("in_set", (column,), {"allowed": list(allowed)})


def unique(*columns: str) -> Expectation:
    return Expectation("compound_unique", columns)


def of_type(column: str, name: str) -> Expectation:
    return Expectation("of_type", (column,), {"name": name})


@dataclass(frozen=True)
class Suite:
    expectations: tuple[Expectation, ...]

    def validate(self, df: DataFrame) -> DataFrame:
        """(expectation, column, success, unexpected_count, total), one row per expectation.

        A missing column fails its expectation; any other problem raises.
        """
        return _validate(df, self.expectations)


def readings_suite(cols: Cols = Cols(), cfg: CheckSettings = CheckSettings()) -> Suite:
    """The suite for half-hourly readings."""
    wanted = [exists(c) for c in (*cols.entity, cols.ts, cols.value)]
    wanted += [not_null(c) for c in (*cols.entity, cols.ts)]
    wanted += [
        between(cols.value, *cfg.value_range),
        unique(*cols.entity, cols.ts),
        of_type(cols.value, "float64"),
    ]
    return Suite(tuple(wanted))


def _validate(df: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    have = set(df.columns)
    counted = [(i, e) for i, e in enumerate(expectations) if e.kind not in ("column_exists", "of_type") and have.issuperset(e.columns)]
    rows_of = [(i, e) for i, e in counted if e.kind != "compound_unique"]
    keyed = [(i, e) for i, e in counted if e.kind == "compound_unique"]
    plain = df.agg(
        F.count(F.lit(1)).alias("total"), *[F.coalesce(F.sum(flag(_broken(e))), F.lit(0)).alias(f"_{i}") for i, e in rows_of]
    )
    if len(keyed) == 1:
        # Grouping by the key answers uniqueness; the other counts ride along on the same pass.
        i, e = keyed[0]
        per_key = df.groupBy(*e.columns).agg(
            F.count(F.lit(1)).alias("_n"), *[F.sum(flag(_broken(x))).alias(f"_{j}") for j, x in rows_of]
        )
        plain = per_key.agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("total"),
            F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n")).otherwise(0)), F.lit(0)).alias(f"_{i}"),
            *[F.coalesce(F.sum(f"_{j}"), F.lit(0)).alias(f"_{j}") for j, _ in rows_of],
        )
    elif keyed:
        for i, e in keyed:
            per_key = df.groupBy(*e.columns).agg(F.count(F.lit(1)).alias("_n"))
            # One row on each side.
            one = per_key.agg(F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n")).otherwise(0)), F.lit(0)).alias(f"_{i}"))
            plain = plain.withColumn("_k", F.lit(1)).join(one.withColumn("_k", F.lit(1)), "_k").drop("_k")
    answered = {i for i, _ in counted}
    out = []
    for i, e in enumerate(expectations):
        if i in answered:
            unexpected: Column = F.col(f"_{i}").cast("long")
            success = unexpected == 0
        else:
            success = F.lit(_static(df, e))
            unexpected = F.lit(None).cast("long")
        out.append(
            F.struct(
                F.lit(e.kind).alias("expectation"),
                F.lit(e.label).alias("column"),
                success.alias("success"),
                unexpected.alias("unexpected_count"),
                F.col("total").cast("long").alias("total"),
            )
        )
    return plain.select(F.explode(F.array(*out)).alias("r")).select("r.*")


def _broken(e: Expectation) -> Column:
    c = F.col(e.columns[0])
    if e.kind == "not_null":
        return c.isNull()
    if e.kind == "between":
        return ~c.between(e.args["low"], e.args["high"])
    if e.kind == "in_set":
        return ~c.isin(e.args["allowed"])
    raise ValueError(f"unknown expectation {e.kind!r}")


def _static(df: DataFrame, e: Expectation) -> bool:
    if not set(df.columns).issuperset(e.columns):
        return False
    if e.kind == "of_type":
        return df.schema[e.columns[0]].dataType.simpleString() == TYPE_NAMES.get(e.args["name"], e.args["name"])
    return True
