import math
import os
import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from sievewatt.functions import geometry as G
from sievewatt.operators import spatial
from sievewatt.sources import geo, raw, sinks
from sievewatt.streaming import ingest

OSM = """<?xml version="1.0"?><osm>
<node id="1" lat="51.0" lon="0.0"/><node id="2" lat="51.0" lon="0.001"/>
<node id="3" lat="51.001" lon="0.001"/><node id="4" lat="51.001" lon="0.0"/>
<way id="10"><nd ref="1"/><nd ref="2"/><nd ref="3"/><nd ref="4"/><nd ref="1"/><tag k="building" v="yes"/></way>
<way id="11"><nd ref="1"/><nd ref="3"/><tag k="amenity" v="bench"/></way>
<way id="12"><nd ref="1"/><nd ref="2"/><tag k="highway" v="path"/></way>
</osm>"""


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)
    return path


def block(*rows):
    return "LCLid,tstp,energy(kWh/hh)\n" + "".join(f"{r}\n" for r in rows)


def test_blocks_are_read_as_one_scan_in_text_order(spark, folder):
    for n in ("1", "2", "10"):
        put(folder, f"block_{n}.csv", block(f"H{n},2012-10-12 00:30:00.0000000, 0.5 ", f"H{n},bad,Null"))
    put(folder, "other.csv", block("X,2012-10-12 00:30:00,1"))
    df = raw.read_readings(spark, folder)
    assert {r["source_block"] for r in df.collect()} == {"1", "2", "10"}
    assert df.filter("energy_kwh = 0.5 and hour(timestamp) = 0").count() == 3
    assert df.filter("timestamp is null and energy_kwh is null").count() == 3
    limited = raw.read_readings(spark, folder, limit_blocks=2)
    assert {r["source_block"] for r in limited.collect()} == {"1", "10"}
    with pytest.raises(ValueError, match="no block"):
        raw.read_readings(spark, folder + "/nothing")


def test_metadata_is_one_string_per_run(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, value string")
    out = raw.with_ingest_metadata(df, "test_source", "batch_001").collect()
    assert {(r["_source"], r["_batch_id"]) for r in out} == {("test_source", "batch_001")}
    auto = raw.with_ingest_metadata(df, "s").select("_batch_id").distinct().collect()
    assert len(auto) == 1 and isinstance(auto[0][0], str)


def test_optional_weather_columns(spark, folder):
    path = put(folder, "w.csv", "time,temperatureMax,summary\n2012-01-01 00:00:00,5.5,rain\n")
    df = raw.read_weather_daily(spark, path)
    assert df.columns == ["date", "temp_max_celsius", "weather_summary"]
    assert df.first()["date"] == date(2012, 1, 1)


def test_names_are_made_safe_and_unique(spark, folder):
    assert raw.safe_names(["a b", "a,b", "a(b)", "c/d=e"]) == ["a_b", "a_b_2", "a_b_", "c_d_e"]
    path = put(folder, "seg.csv", "MAIN CATEGORIES,ACORN-A\nx,1\n")
    assert raw.read_segments(spark, path).columns == ["MAIN_CATEGORIES", "ACORN-A"]


def test_missing_optional_source_is_empty(spark, folder):
    df = raw.read_optional(lambda: raw.read_holidays(spark, folder + "/none.csv"), spark, raw.HOLIDAY_OUT)
    assert df.count() == 0 and df.columns == ["holiday_date"]
    path = put(folder, "h.csv", "Bank holidays,Type\n2012-12-25,Christmas\n")
    assert raw.read_holidays(spark, path).first()["holiday_date"] == date(2012, 12, 25)


def test_stream_equals_batch_and_restarts_cleanly(spark, folder):
    src, target, check = folder + "/src", folder + "/table", folder + "/check"
    put(src, "block_1.csv", block("A,2012-10-12 00:30:00.0000000,0.5", "A,2012-10-12 01:00:00.0000000,Null"))
    for _ in range(2):
        ingest.write_stream(ingest.stream_readings(spark, src), target, check, trigger=None).awaitTermination()
    assert sinks.read_parts(spark, target).count() == 2
    put(src, "block_2.csv", block("B,2012-10-12 00:30:00.0000000,1.5"))
    ingest.write_stream(ingest.stream_readings(spark, src, 1), target, check, trigger=None).awaitTermination()
    columns = ["household_id", "timestamp", "energy_kwh", "source_block"]
    streamed = sinks.read_parts(spark, target).select(columns).collect()
    batch = raw.read_readings(spark, src).select(columns).collect()
    assert sorted(map(repr, streamed)) == sorted(map(repr, batch))


def test_replayed_stream_batch_is_not_written_twice(spark, folder):
    """A crash after the table write and before the checkpoint commit replays the batch."""
    src, target = folder + "/src", folder + "/table"
    put(src, "block_1.csv", block("A,2012-10-12 00:30:00.0000000,0.5"))
    for check in ("/c1", "/c2"):  # a lost checkpoint: the same batch number comes again
        ingest.write_stream(
            ingest.stream_readings(spark, src), target, folder + check, trigger=None, writer="meter-feed"
        ).awaitTermination()
    assert sinks.read_parts(spark, target).count() == 1


def test_a_part_written_again_replaces_itself(spark, folder):
    rows = lambda *r: spark.createDataFrame(r, "day date, id long")
    one, two = date(2012, 1, 1), date(2012, 1, 2)
    path = folder + "/parts"
    assert not sinks.exists(spark, path)
    assert sinks.replace_parts(rows((one, 1), (one, 2), (two, 3)), path, ["day"]) == 3
    assert sinks.replace_parts(rows((one, 4)).withColumn("note", F.lit("later")), path, ["day"]) == 1
    assert sinks.replace_parts(rows().limit(0), path, ["day"]) == 0
    got = sorted((r["day"], r["id"], r["note"]) for r in sinks.read_parts(spark, path).collect())
    assert got == [(one, 4, "later"), (two, 3, None)] and sinks.exists(spark, path)
    assert sinks.batch_name("a", 1) != sinks.batch_name("b", 1)


def test_weather_stream(spark, folder):
    src = folder + "/w"
    put(src, "a.csv", "time,temperature,apparentTemperature,humidity,pressure,windSpeed,windBearing,visibility,dewPoint,precipType,icon,summary\n"
        "2012-01-01 05:00:00,1.5,1,0.5,1000,2,3,4,5,rain,i,s\n")
    ingest.write_stream(ingest.stream_weather(spark, src), folder + "/t", folder + "/c", "weather", trigger=None).awaitTermination()
    row = sinks.read_parts(spark, folder + "/t").first()
    assert (row["timestamp"], row["temperature_celsius"], row["_source"]) == (datetime(2012, 1, 1, 5), 1.5, "weather")


def test_osm_buildings(spark, folder):
    path = put(folder, "b.xml", OSM)
    rows = {r["building_id"]: r for r in geo.osm_buildings(spark, path, ["building", "amenity"]).collect()}
    assert set(rows) == {"way_10", "way_11"}
    house = rows["way_10"]
    assert house["building_type"] == "yes" and house["osm_tags"] == {"building": "yes"} and house["source_file"] == "b.xml"
    assert [(p["x"], p["y"]) for p in house["rings"][0]] == [(0.0, 51.0), (0.001, 51.0), (0.001, 51.001), (0.0, 51.001), (0.0, 51.0)]
    assert house["area_m2"] == pytest.approx(111.19508 * 111.19508 * 0.62932, rel=1e-3)
    assert rows["way_11"]["area_m2"] == 0.0 and rows["way_11"]["building_type"] == "unknown"
    assert geo.osm_buildings(spark, path, ["building", "amenity"], min_area=10.0).count() == 1
    assert geo.no_buildings(spark).columns == geo.osm_buildings(spark, path).columns


def square(x0, y0, x1, y1):
    return [(float(x), float(y)) for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))]


@pytest.fixture
def areas(spark):
    rows = [
        ("holed", "Holed", [square(0, 0, 10, 10), square(4, 4, 6, 6)]),
        ("twin", "Twin", [square(20, 0, 21, 1), square(30, 0, 31, 1)]),
        ("empty", "Empty", [square(50, 50, 51, 51)]),
    ]
    return spark.createDataFrame(rows, f"gid_3 string, district string, rings {G.RINGS_TYPE}")


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": -1, "hot_rows": 5}])
@pytest.mark.parametrize("cell", [0.7, 3.0, 100.0])
def test_points_within_matches_brute_force(spark, areas, cell, options):
    pts = [(i, (i * 7 % 340) / 10 + 0.05, (i * 13 % 110) / 10 + 0.05) for i in range(400)]
    points = spark.createDataFrame(pts, "id int, x double, y double").repartition(4)
    found = spatial.points_within(points, areas.withColumnRenamed("gid_3", "area_id"), cell, **options)
    got = {(r["id"], r["area_id"]) for r in found.collect()}

    def inside(x, y, a, b, c, d):
        return a < x < c and b < y < d

    want = set()
    for i, x, y in pts:
        if inside(x, y, 0, 0, 10, 10) and not inside(x, y, 4, 4, 6, 6):
            want.add((i, "holed"))
        if inside(x, y, 20, 0, 21, 1) or inside(x, y, 30, 0, 31, 1):
            want.add((i, "twin"))
    assert got == want


def test_buildings_by_area_shows_empty_areas(spark, areas):
    rows = [("a", [square(1, 1, 2, 2)], 5.0), ("b", [square(4.5, 4.5, 5.5, 5.5)], 7.0), ("c", [square(30.1, 0.1, 30.9, 0.9)], 1.0)]
    buildings = spark.createDataFrame(rows, f"building_id string, rings {G.RINGS_TYPE}, area_m2 double")
    out = {r["admin_area_id"]: (r["building_count"], r["total_area_m2"]) for r in spatial.buildings_by_area(buildings, areas, 2.0).collect()}
    assert out == {"holed": (1, 5.0), "twin": (1, 1.0), "empty": (0, 0.0)}
    assert spatial.admin_columns(["GID_2", "county"], 2) == ("GID_2", "county")
    assert spatial.admin_columns(["county"], 2) == (None, "county")
    with pytest.raises(ValueError):
        spatial.admin_columns(["x"], 3)


def test_geojson_multipolygon_and_collection(spark, folder):
    multi = '{"type":"Feature","properties":{"GID_2":"G1","COUNTRY":"UK","NAME_1":"R","NAME_2":"C"},"geometry":{"type":"MultiPolygon","coordinates":[[[[0,0],[1,0],[1,1],[0,0]]],[[[5,5],[6,5],[6,6],[5,5]]]]}}'
    path = put(folder, "l2.json", multi + "\n")
    row = geo.admin_areas(spark, path, 2).first()
    assert (row["gid_2"], row["country"], row["county"], row["admin_level"], row["crs"]) == ("G1", "UK", "C", 2, "EPSG:4326")
    assert len(row["rings"]) == 2
    whole = put(folder, "fc.geojson", '{"type":"FeatureCollection",\n"features":[' + multi + "]}")
    assert geo.admin_areas(spark, whole, 2, multi_line=True).count() == 1
    assert geo.admin_areas(spark, whole, 2).count() == 1
    on_a_line = put(folder, "line.geojson", '{"type":"FeatureCollection","features":[' + multi + "," + multi + "]}\n")
    assert geo.admin_areas(spark, on_a_line, 2).count() == 2
    assert geo.admin_areas(spark, put(folder, "none.geojson", '{"type":"FeatureCollection","features":[]}'), 2).count() == 0
    with pytest.raises(ValueError):
        geo.admin_areas(spark, put(folder, "other.json", '{"a":\n1}'), 2)


def test_repeated_tags_and_missing_nodes(spark, folder):
    nodes = "".join(f'<node id="{i}" lat="51.{i}" lon="0.{i}"/>' for i in (1, 2, 3))
    way = '<way id="7">' + "".join(f'<nd ref="{i}"/>' for i in (1, 2, 3, 4, 1)) + '<tag k="building" v="yes"/><tag k="building" v="shed"/></way>'
    row = geo.osm_buildings(spark, put(folder, "hole.xml", f"<osm>{nodes}{way}</osm>"), ["building"]).first()
    assert (row["building_type"], row["missing_nodes"], row["area_m2"], len(row["rings"][0])) == ("shed", 1, None, 4)


def test_cell_table_is_measured(spark, areas):
    named = areas.withColumnRenamed("gid_3", "area_id")
    sizes = {}
    for c in (1.0, 0.1, 0.05):
        cells = spatial.area_cells(named, c)
        edges, rows = cells.agg(F.sum(F.size("edges")), F.count("*")).first()
        sizes[c] = spatial.cells_bytes(cells)
        assert sizes[c] == 96 * rows + 48 * edges
        # an outline of length 56 passes 56 / c cells, each side of a square touches a few more
        assert edges <= 2 * (56 / c + 4 * 20)
        assert rows <= 100 / c**2 + edges
    # no edge is carried to cells it does not touch
    assert sizes[0.05] < 4.2 * sizes[0.1]


def ray(rings, x, y):
    """Inside by the plain count of all edges a ray to the right crosses."""
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, [*ring[1:], ring[0]], strict=True):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd = not odd
    return odd


@pytest.mark.parametrize("cell", [0.25, 0.7, 5.0])
def test_points_in_ragged_outlines(spark, cell):
    """Slanted edges, corners and points on the grid's own lines, outlines through corners of cells."""
    rng = random.Random(8)
    rows = []
    for k in range(12):
        angles = sorted(rng.uniform(0, 6.283) for _ in range(rng.randint(3, 25)))
        polar = [(rng.uniform(1, 3), a) for a in angles]
        ring = [(r * math.cos(a), r * math.sin(a)) for r, a in polar]
        if k % 2:  # corners on the lines of the grid
            ring = [(round(x * 4) / 4, round(y * 4) / 4) for x, y in ring]
        rows.append((str(k), [ring]))
    rows.append(("diamond", [[(0.0, -2.0), (2.0, 0.0), (0.0, 2.0), (-2.0, 0.0)], [(0.0, -1.0), (1.0, 0.0), (0.0, 1.0), (-1.0, 0.0)]]))
    areas = spark.createDataFrame(rows, f"area_id string, rings {G.RINGS_TYPE}")
    pts = [(i, rng.uniform(-3.5, 3.5), rng.uniform(-3.5, 3.5)) for i in range(400)]
    pts += [(1000 + i, (i % 25 - 12) / 4, (i // 25 - 12) / 4) for i in range(625)]
    found = spatial.points_within(spark.createDataFrame(pts, "id int, x double, y double"), areas, cell)
    assert {(r["id"], r["area_id"]) for r in found.collect()} == {(i, k) for i, x, y in pts for k, rings in rows if ray(rings, x, y)}


def test_outlines_that_touch(spark):
    left = [("holed", [square(0, 0, 10, 10), square(4, 4, 6, 6)]), ("far", [square(90, 90, 91, 91)])]
    right = {
        "crossing": (square(9, 9, 12, 12), True), "nested": (square(1, 1, 2, 2), False), "in the hole": (square(4.5, 4.5, 5, 5), None),
        "around": (square(-1, -1, 11, 11), False), "beside": (square(10, 0, 12, 10), True), "at a corner": (square(10, 10, 11, 11), True),
        "apart": (square(10.1, 0, 12, 10), None), "in the hole at its side": (square(4, 4.5, 5, 5), True), "same": (square(0, 0, 10, 10), True),
        "slanted": ([(-5.0, 5.0), (5.0, -5.0), (-5.0, -5.0)], True), "slanted apart": ([(-5.0, 4.0), (4.0, -5.0), (-5.0, -5.0)], None),
    }
    schema = f"area_id string, rings {G.RINGS_TYPE}"
    b = spark.createDataFrame([(k, [ring]) for k, (ring, _) in right.items()], schema)
    for cell in (0.7, 3.0, 50.0):
        got = spatial.areas_touching(spark.createDataFrame(left, schema), b, cell).collect()
        assert {(r["left_id"], r["right_id"], r["boundaries_meet"]) for r in got} == {("holed", k, m) for k, (_, m) in right.items() if m is not None}


def test_areas_without_ids_get_the_same_numbers(spark):
    rows = [(f"area {i * 37 % 50}", [square(i, 0, i + 1, 1)]) for i in range(50)] + [("area 7", [square(99, 0, 100, 1)])]
    df = spark.createDataFrame(rows, f"district string, rings {G.RINGS_TYPE}")
    found = [
        sorted((int(r["area_id"]), r["admin_area_name"], r["rings"][0][0]["x"]) for r in spatial.named_areas(df.repartition(n)).collect()) for n in (1, 8)
    ]
    assert found[0] == found[1]
    assert [f[0] for f in found[0]] == list(range(51)) and [f[1] for f in found[0]] == sorted(r[0] for r in rows)


def test_ring_area(spark):
    df = spark.createDataFrame([([square(0, 0, 2, 3)],)], f"rings {G.RINGS_TYPE}")
    assert df.select(G.ring_area(F.col("rings")[0])).first()[0] == 6.0
    assert df.select(G.bounds(F.col("rings")).alias("b")).select("b.*").first().asDict() == {"x_min": 0, "y_min": 0, "x_max": 2, "y_max": 3}
