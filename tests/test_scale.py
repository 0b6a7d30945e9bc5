"""Work that follows the rows: tasks by number of rows, micro-batches that are not too many, expressions that do not swell."""

import math
import os

import pytest
from pyspark.sql import functions as F

from catalog import files, queries
from sievewatt.functions import geometry as G
from sievewatt.config import Cols, Settings
from sievewatt.operators import clean, spatial
from sievewatt.plans import layers
from sievewatt.runtime import spread
from sievewatt.sources import geo, raw, tables

SQUARE = [(0.0, 50.0), (0.001, 50.0), (0.001, 50.002), (0.0, 50.002), (0.0, 50.0)]


def outlines(spark, n):
    ring = F.array(*[G.point(F.col("id") % 5 + x, F.lit(y)) for x, y in SQUARE])
    return spark.range(0, n, 1, 1).select(F.col("id").cast("string").alias("building_id"), F.array(ring).alias("rings"), G.ring_area_m2(ring).alias("area_m2"))


def test_area_of_a_ring_names_the_ring_once(spark):
    rows = spark.range(1).select(F.array(*[G.point(F.lit(x), F.lit(y)) for x, y in SQUARE]).alias("ring"))
    told = rows.select(G.ring_area_m2(F.col("ring")).alias("a"), G.centroid(F.col("ring")).alias("c"))
    plan = told._jdf.queryExecution().analyzed().toString()
    assert plan.count("array_min") == 1
    got = told.first()
    assert abs(got["a"] / (0.002 * 0.001 * G.METRES_PER_DEGREE**2 * math.cos(math.radians(50.001))) - 1) < 1e-9
    assert (round(got["c"]["x"], 9), round(got["c"]["y"], 9)) == (0.0005, 50.001)


def test_a_ring_that_is_null_has_no_edges(spark):
    ring = "array<struct<x:double,y:double>>"
    rows = spark.createDataFrame([(None,)], f"ring {ring}")
    assert [r["n"] for r in rows.select(F.size(F.coalesce(G.edges(F.array("ring")), F.array())).alias("n")).collect()] == [0]


def test_rows_of_one_file_are_dealt_over_tasks(spark):
    assert spread(spark.range(0, 100, 1, 1), 10).rdd.getNumPartitions() == 10
    assert spread(spark.range(0, 100, 1, 1), 100).rdd.getNumPartitions() == 1


def test_points_are_dealt_over_tasks_before_they_are_looked_up(spark, monkeypatch):
    monkeypatch.setattr(spatial, "POINTS_PER_TASK", 10)
    corners = [(0.0, 49.0), (2.5, 49.0), (2.5, 51.0), (0.0, 51.0)]
    rings = F.array(F.array(*[G.point(F.lit(x), F.lit(y)) for x, y in corners]))
    areas = spark.range(1).select(F.lit("a").alias("gid_3"), F.lit("A").alias("district"), rings.alias("rings"))
    out = spatial.buildings_by_area(outlines(spark, 50), areas, 0.25)
    assert "Repartition 5, true" in out._jdf.queryExecution().optimizedPlan().toString()
    assert [(r["admin_area_id"], r["building_count"]) for r in out.collect()] == [("a", 30)]


def test_a_stream_of_many_rows_has_few_micro_batches(spark):
    rows = spark.range(0, 400_000, 1, 4).withColumnRenamed("id", "event_id")
    folder, taken = files.stream_files(rows, "event_id")
    there = sorted(f for f in os.listdir(folder) if f.endswith(".parquet"))
    ends = [spark.read.parquet(f"{folder}/{f}").agg(F.min("event_id"), F.max("event_id"), F.count("*")).first() for f in there]
    assert len(there) / taken <= 8 and sum(e[2] for e in ends) == 400_000
    # in the order of the key, each of bounded size
    assert all(a[1] < b[0] for a, b in zip(ends, ends[1:])) and max(e[2] for e in ends) <= files.STREAM_ROWS


def test_files_in_a_micro_batch():
    assert [files.per_trigger(n, 3, 12) for n in (1, 3, 10, 60, 3600)] == [1, 1, 3, 12, 12]


def test_many_blocks_are_written_by_few_tasks_and_streamed_in_few_batches(spark):
    rows = spark.range(0, 300, 1, 3).select("id", F.floor(F.col("id") / 3).alias("block"))
    folder = files.write_blocks(rows, "blocks")
    read = spark.read.option("header", True).csv(folder).select("id", F.regexp_extract(F.col("_metadata.file_name"), "block_(.*).csv", 1).alias("b"))
    assert sorted((int(r["id"]), int(r["b"])) for r in read.collect()) == [(i, i // 3) for i in range(300)]
    assert files.blocks_per_trigger(spark, folder) == 12


def test_streams_keep_their_state_on_disk(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    with queries._state_on_disk(spark):
        assert "RocksDB" in spark.conf.get(key)
    assert spark.conf.get(key, None) == before


@pytest.mark.parametrize("large", [False, True])
def test_only_large_blocks_get_a_folder_each(spark, tmp_path, monkeypatch, large):
    monkeypatch.setattr(raw, "FOLDER_BYTES", 1 if large else 1000)
    os.makedirs(tmp_path / "blocks")
    for i in range(20):
        with open(tmp_path / "blocks" / f"block_{i or ''}.csv", "w", encoding="utf-8") as fh:
            fh.write(f"LCLid,tstp,energy(kWh/hh)\nH{i},2013-01-01 00:00:00.0000000,1.0\n")
    run = layers.Run(spark, Settings(paths={"halfhourly_dir": str(tmp_path / "blocks"), "household_info": "", "weather_hourly": "", "bronze_root": str(tmp_path)}))
    layers.sources(run)["halfhourly_consumption"]()
    rows = run.load("bronze", "halfhourly_consumption")
    assert {(r["household_id"], r["source_block"]) for r in rows.collect()} == {(f"H{i}", str(i) if i else None) for i in range(20)}
    assert (len(rows.inputFiles()) == 20) == large
    assert (tables.log(spark, run.path("bronze", "halfhourly_consumption")).first()["partition_by"] == ["source_block"]) == large


def test_rejected_readings_are_found_in_one_shuffle(spark):
    cols = Cols(("k",), "ts", "v", None)
    rows = [("a", 1, 1.0), ("a", 1, 1.0), ("a", 1, 2.0), ("a", 2, -1.0), ("b", 1, None), ("b", 1, None), (None, None, 99.0), (None, None, 99.0)]
    df = spark.createDataFrame(rows, "k string, n int, v double").select("k", F.timestamp_seconds("n").alias("ts"), "v")
    one, sliced = clean.rejected_readings(df, cols), clean.rejected_readings(df, cols, rows_per_slice=1)
    found = sorted((r["k"] or "", r["v"] or 0.0, r["reject_reason"], r["row_count"]) for r in one.collect())
    assert found == sorted((r["k"] or "", r["v"] or 0.0, r["reject_reason"], r["row_count"]) for r in sliced.collect())
    assert found == [
        ("", 99.0, "above_max", 1), ("", 99.0, "duplicate", 1), ("a", -1.0, "below_min", 1), ("a", 1.0, "duplicate", 1),
        ("a", 2.0, "duplicate", 1), ("b", 0.0, "duplicate", 1), ("b", 0.0, "not_imputable", 1),
    ]
    plan = one._jdf.queryExecution().executedPlan().toString().split("\n")
    shuffles = [line for line in plan if "Exchange hashpartitioning(" in line]
    assert shuffles and all("REPARTITION_BY_NUM" in line for line in shuffles)


def test_ways_are_parsed_once(spark, tmp_path):
    nodes = "".join(f'<node id="{i}" lat="{50 + i // 2 / 10}" lon="{i % 2 / 10}"/>' for i in range(3))
    way = '<way id="7"><nd ref="0"/><nd ref="1"/><nd ref="2"/><nd ref="0"/><tag k="building" v="yes"/></way>'
    (tmp_path / "map.xml").write_text(f"<osm>{nodes}{way}</osm>", encoding="utf-8")
    out = geo.osm_buildings(spark, str(tmp_path / "map.xml"))
    plan = out._jdf.queryExecution().optimizedPlan().toString().split("\n")
    assert len([line for line in plan if "Relation" in line and line.rstrip().endswith("xml")]) == 1
    assert [r["building_id"] for r in out.collect()] == ["way_7"]
