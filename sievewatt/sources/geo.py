"""Geographic sources: administrative areas from GeoJSON, buildings from OSM XML."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievewatt.functions import geometry as G
from sievewatt.runtime import scratch_path

DEFAULT_CRS = "EPSG:4326"

BUILDING_SCHEMA = f"""
    building_id string, building_type string, landuse string, amenity string,
    rings {G.RINGS_TYPE}, area_m2 double, missing_nodes int, osm_tags map<string,string>, source_file string, crs string
"""

# Property of a boundary file -> our column, for the levels above the area itself.
AREA_PROPERTIES = {"COUNTRY": "country", "NAME_1": "region", "NAME_2": "county", "NAME_3": "district"}

_NODE = "_id bigint, _lat double, _lon double"
_WAY = "_id bigint, nd array<struct<_ref:bigint>>, tag array<struct<_k:string,_v:string>>"


def admin_areas(spark: SparkSession, path: str, level: int, crs: str = DEFAULT_CRS, multi_line: bool | None = None) -> DataFrame:
    """Areas of one level from GeoJSON features (one per line, or a FeatureCollection).

    Keeps those of the usual properties that the file has. Polygons and multi-polygons both become a
    flat list of rings. Whether a feature or a whole collection stands on a line, or a collection is
    spread over lines, is found out unless ``multi_line`` says so; a spread-out file is read by one task.
    Features without a geometry are no areas; a file none of whose rows holds a feature is an error.
    """
    names = [f"GID_{level}", *[p for p in AREA_PROPERTIES if p == "COUNTRY" or int(p[-1]) <= level]]
    feature = T.StructType(
        [
            T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
            T.StructField(
                "geometry",
                T.StructType([T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())]),
            ),
        ]
    )
    record = T.StructType([*feature.fields, T.StructField("features", T.ArrayType(feature))])

    def features(spread: bool) -> DataFrame:
        read = spark.read.schema(record).option("multiLine", spread).json(path)
        alone = F.array(F.struct("properties", "geometry"))
        return read.select(F.explode(F.coalesce("features", alone)).alias("f")).select("f.*")

    def none(rows: DataFrame) -> bool:
        return rows.filter("properties IS NOT NULL OR geometry IS NOT NULL").isEmpty()

    rows = features(bool(multi_line))
    if multi_line is None and none(rows):
        rows = features(True)
    if none(rows) and not spark.read.text(path).filter("trim(value) <> ''").isEmpty() and not _empty_collection(spark, path):
        raise ValueError(f"no GeoJSON feature found in {path}")
    present = set(
        # Property names only: at most the handful asked for.
        rows.select(F.explode(F.map_keys("properties")).alias("k")).filter(F.col("k").isin(names)).distinct().toPandas()["k"]
    )
    gid = f"GID_{level}"
    columns = [F.col("properties")[gid].alias(f"gid_{level}")] if gid in present else []
    columns += [F.col("properties")[p].alias(AREA_PROPERTIES[p]) for p in names[1:] if p in present]
    return rows.filter(F.col("geometry.type").isin("Polygon", "MultiPolygon")).select(
        *columns, _rings().alias("rings"), F.lit(level).alias("admin_level"), F.lit(crs).alias("crs")
    )


def _empty_collection(spark: SparkSession, path: str) -> bool:
    """Whether the file is a collection that simply has no features."""
    whole = spark.read.schema("type string, features array<string>").option("multiLine", True).json(path)
    return not whole.filter("type = 'FeatureCollection' AND size(features) = 0").isEmpty()


def _rings():
    text = F.col("geometry.coordinates")
    one = F.from_json(text, "array<array<array<double>>>")
    many = F.flatten(F.from_json(text, "array<array<array<array<double>>>>"))
    pairs = F.when(F.col("geometry.type") == "Polygon", one).otherwise(many)
    return F.transform(pairs, lambda ring: F.transform(ring, lambda p: G.point(p[0], p[1])))


def osm_buildings(
    spark: SparkSession,
    path: str,
    tag_keys: Sequence[str] = ("building",),
    min_area: float = 0.0,
    crs: str = DEFAULT_CRS,
) -> DataFrame:
    """Ways that carry any of the tag keys, with footprint and area.

    ``path`` is an OSM XML file or a folder of them. Node positions come in by a join on the node
    number; a way's corners are put back in order by their place in it. A way that does not close
    keeps its line and has an area of 0. A way with nodes that are missing from the file keeps the corners
    it has, its area is null and ``missing_nodes`` counts them. Of a repeated tag the last value holds.
    """
    # Parsed once, as the corners and the rows themselves are both made of them.
    ways = _stored(
        _xml(spark, path, "way", _WAY)
        .filter(F.exists("tag", lambda t: t["_k"].isin(list(tag_keys))))
        .select(
            "_id",
            _last_tags().alias("osm_tags"),
            F.coalesce("nd", F.expr("cast(array() as array<struct<_ref:bigint>>)")).alias("nd"),
            F.col("_metadata.file_name").alias("source_file"),
        )
    )
    nodes = _xml(spark, path, "node", _NODE).select(F.col("_id").alias("_ref"), "_lon", "_lat")
    # A way has at most 2000 corners in OSM, so the list per way is short.
    corners = (
        ways.select("_id", F.posexplode(F.col("nd._ref")).alias("_pos", "_ref"))
        .join(nodes, "_ref")
        .groupBy("_id")
        .agg(F.array_sort(F.collect_list(F.struct("_pos", G.point(F.col("_lon"), F.col("_lat")).alias("p")))).alias("c"))
        .select("_id", F.transform("c", lambda c: c["p"]).alias("_ring"))
    )
    # A closed way names its first node twice, so places are counted, not nodes.
    missing = (F.size("nd") - F.coalesce(F.size("_ring"), F.lit(0))).alias("missing_nodes")
    area = F.when(missing > 0, None).when(G.is_closed(F.col("_ring")), G.ring_area_m2(F.col("_ring"))).otherwise(0.0)
    tag = lambda k: F.try_element_at("osm_tags", F.lit(k))
    out = ways.join(corners, "_id", "left").select(
        F.concat(F.lit("way_"), F.col("_id").cast("string")).alias("building_id"),
        F.coalesce(tag("building"), F.lit("unknown")).alias("building_type"),
        tag("landuse").alias("landuse"),
        tag("amenity").alias("amenity"),
        F.when(F.size("_ring") > 0, F.array("_ring")).alias("rings"),
        area.alias("area_m2"),
        missing,
        "osm_tags",
        "source_file",
        F.lit(crs).alias("crs"),
    )
    return out.filter(F.col("area_m2") >= min_area) if min_area > 0 else out


def _last_tags():
    named = F.filter("tag", lambda t: t["_k"].isNotNull())
    last = F.filter(
        named, lambda t, i: ~F.exists(F.slice(named, i + 2, F.size(named)), lambda later: later["_k"] == t["_k"])
    )
    return F.map_from_entries(F.transform(last, lambda t: F.struct(t["_k"], t["_v"])))


def no_buildings(spark: SparkSession) -> DataFrame:
    """The buildings table without rows, for runs that have no OSM file."""
    return spark.createDataFrame([], BUILDING_SCHEMA)


def _stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder, and read from there."""
    path = scratch_path(df.sparkSession, "ways")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _xml(spark: SparkSession, path: str, tag: str, schema: str) -> DataFrame:
    reader = spark.read.format("xml").option("rowTag", tag).option("recursiveFileLookup", True)
    return reader.schema(schema).load(path)
