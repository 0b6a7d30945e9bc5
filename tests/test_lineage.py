"""Steps that run at once, what the audit log tells of a run, and what follows from what."""

import threading
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievewatt.config import Settings
from sievewatt.governance import audit, lineage
from sievewatt.plans.layers import Run, check_columns
from sievewatt.sources import tables

EDGES = "target string, target_version long, source string, source_version long"


def run_in(spark, folder, **options):
    return Run(spark, Settings(paths={f"{n}_root": f"{folder}/{n}" for n in ("bronze", "silver", "gold")}, **options))


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_steps_run_at_once_and_all_end(spark, folder):
    run, ended = run_in(spark, folder), []
    both = threading.Barrier(2, timeout=60)

    def step(name, error=None):
        if name in ("a", "b"):
            both.wait()  # neither can end before the other has started
        ended.append((name, spark.sparkContext.getLocalProperty("spark.scheduler.pool"), spark.range(3).count()))
        if error:
            raise error

    steps = {
        "a": lambda: step("a", ValueError("first")),
        "b": lambda: step("b", KeyError("second")),
        "c": lambda: step("c", OSError("third")),
        "d": lambda: step("d"),
    }
    with pytest.raises(ValueError, match="first"):
        run.together(steps, optional=["c"])
    assert sorted(ended) == [(n, n, 3) for n in "abcd"]
    assert run.skipped == ["c: third"]
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None
    run.together({})


def test_versions_read_and_written_are_kept_apart(spark, folder):
    log = f"{folder}/gold/audit_log"
    one = run_in(spark, folder)
    with one.logged("first"):
        one.save(spark.range(4), "bronze", "a", ["/files/a.csv"])
        one.save(spark.range(2), "bronze", "b", ["/files/b.csv"])
    two = run_in(spark, folder)
    with two.logged("second"):
        two.save(two.load("bronze", "a"), "bronze", "a", ["/files/a.csv"])
        joined = two.load("bronze", "a").join(two.load("bronze", "b"), "id")
        two.save(joined, "silver", "c", two.paths("bronze/a", "bronze/b"))
    newest = audit.query_runs(spark, log, "second").first()
    a, b, c = run_in(spark, folder).paths("bronze/a", "bronze/b", "silver/c")
    assert newest["input_versions"] == {a: 1, b: 0} and newest["output_versions"] == {a: 1, c: 0}
    assert newest["row_counts"] == {a: 4, c: 2} and newest["status"] == "SUCCESS"
    edges = lineage.edges(tables.read(spark, log))
    assert found(edges) == sorted(
        [(a, 0, "/files/a.csv", None), (b, 0, "/files/b.csv", None), (a, 1, "/files/a.csv", None), (c, 0, a, 1), (c, 0, b, 0)], key=str
    )
    starts = spark.createDataFrame([(a, 0), (a, 1), ("/files/b.csv", None)], "path string, version long")
    assert found(lineage.reached(edges, starts)) == sorted([(a, 1, c, 0, 1), ("/files/b.csv", None, b, 0, 1), ("/files/b.csv", None, c, 0, 2)], key=str)
    made_of = lineage.reached(edges, spark.createDataFrame([(c, 0)], "path string, version long"), upstream=True)
    assert {(r["path"], r["version"], r["steps"]) for r in made_of.collect()} == {
        (a, 1, 1), (b, 0, 1), ("/files/a.csv", None, 2), ("/files/b.csv", None, 2),
    }


def test_shortest_way_cycles_and_no_edges(spark):
    rows = [("b", 0, "a", 0), ("c", 0, "b", 0), ("c", 0, "a", 0), ("a", 1, "c", 0), ("d", 0, "a", 1), ("d", 0, "a", 1)]
    edges = spark.createDataFrame(rows, EDGES)
    starts = spark.createDataFrame([("a", 0), ("d", 0)], "path string, version long")
    assert found(lineage.reached(edges, starts)) == [("a", 0, "a", 1, 2), ("a", 0, "b", 0, 1), ("a", 0, "c", 0, 1), ("a", 0, "d", 0, 3)]
    # whatever the version, a follows from itself; its way round ends
    names = lineage.reached(edges, starts.filter("path = 'a'"), versions=False)
    assert {(r["path"], r["steps"]) for r in names.collect()} == {("b", 1), ("c", 1), ("d", 1)}
    assert lineage.reached(edges.limit(0), starts).count() == 0
    assert lineage.reached(edges, starts.limit(0)).count() == 0


def test_a_log_of_before_gets_the_new_columns(spark, folder):
    path = folder + "/audit"
    at = datetime(2024, 1, 1)
    old = T.StructType([f for f in T._parse_datatype_string(audit.AUDIT_SCHEMA).fields if f.name not in ("output_versions", "lineage")])
    tables.write(spark.createDataFrame([("old", at, "SUCCESS", None, "{}", {}, {}, {}, 0, {})], old), path)
    audit.log_run(spark, path, "new", output_versions={"t": 3}, lineage=[("t", 3, "f", None)])
    rows = {r["pipeline_name"]: r for r in audit.query_runs(spark, path).collect()}
    assert rows["old"]["lineage"] is None and rows["new"]["output_versions"] == {"t": 3}
    assert lineage.edges(tables.read(spark, path)).count() == 1


def test_modes_of_schema_evolution_reach_a_run(spark, folder):
    old = spark.range(2).withColumn("x", F.lit(1))
    run_in(spark, folder).save(old, "bronze", "t")
    wider, other, less = old.withColumn("y", F.lit(2)), old.withColumn("x", F.lit("1")), old.drop("x")
    strict = {"evolution_mode": "fail"}
    for df, options in (
        (other, strict), (less, strict), (wider, {**strict, "allow_additional_columns": False}), (wider, {"allow_additional_columns": False}),
    ):
        with pytest.raises(ValueError, match="columns removed"):
            run_in(spark, folder, **options).save(df, "bronze", "t")
    run_in(spark, folder, **strict).save(wider, "bronze", "t")
    run_in(spark, folder, evolution_mode="overwrite", allow_additional_columns=False).save(other.withColumn("z", F.lit(0)), "bronze", "t")
    assert run_in(spark, folder).load("bronze", "t").columns == ["id", "x", "z"]
    check_columns(old.schema, less.schema, "merge", False)
