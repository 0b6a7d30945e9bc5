"""Points in areas and buildings per area, as an equi join on grid cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievewatt.functions import geometry as G
from sievewatt.operators.ordered import row_numbers
from sievewatt.operators.skew import HOT_ROWS, hot_keys
from sievewatt.runtime import BROADCAST_BYTES, durable, spread


# Added to both sides of the columns an edge passes, as a share of a cell, against rounding; one cell more does no harm.
MARGIN = 1e-6

# Points that one task looks up; each is compared with every edge of its cell.
POINTS_PER_TASK = 5_000


def _touched(edges: DataFrame, keys: Sequence[str], cell: float) -> DataFrame:
    """(keys..., e, cx, cy): each edge ``e`` once per cell it touches."""
    rising = F.sequence(G.cell(F.least("e.y1", "e.y2"), cell), G.cell(F.greatest("e.y1", "e.y2"), cell))
    rows = edges.withColumn("cy", F.explode(rising))
    bottom = F.col("cy") * F.lit(float(cell))
    low = F.greatest(F.least("e.y1", "e.y2"), bottom)
    high = F.least(F.greatest("e.y1", "e.y2"), bottom + F.lit(float(cell)))
    level = F.col("e.y1") == F.col("e.y2")
    ends = [F.when(level, F.col(f"e.x{i}")).otherwise(G.met_at(F.col("e"), y)) for i, y in ((1, low), (2, high))]
    from_x, to_x = F.least(*ends) - F.lit(MARGIN * cell), F.greatest(*ends) + F.lit(MARGIN * cell)
    return rows.select(*keys, "e", "cy", F.explode(F.sequence(G.cell(from_x, cell), G.cell(to_x, cell))).alias("cx"))


def area_cells(areas: DataFrame, cell: float) -> DataFrame:
    """(area_id, cx, cy, edges, corner_inside): the cells that an area reaches.

    A cell has the edges that touch it and whether its lower right corner lies inside. Cells without an edge are
    listed where they are inside. So there is a row per cell, and an edge is repeated only for the cells it passes.
    Whether corners are inside comes from one running count per row of cells: how many edges meet the row's lower
    line further to the right.
    """
    edges = areas.select("area_id", F.explode(G.edges(F.col("rings"))).alias("e"))
    touched = _touched(edges, ["area_id"], cell)
    low, high = F.least("e.y1", "e.y2"), F.greatest("e.y1", "e.y2")
    lines = edges.filter("e.y1 <> e.y2").withColumn("cy", F.explode(F.sequence(G.cell(low, cell), G.cell(high, cell))))
    bottom = F.col("cy") * F.lit(float(cell))
    met = lines.filter(G.height_met(F.col("e"), bottom)).select(
        "area_id", G.cell(G.met_at(F.col("e"), bottom), cell).alias("cx"), "cy", F.lit(None).alias("e"), F.lit(1).alias("met")
    )
    own = touched.withColumn("met", F.lit(0)).unionByName(met).groupBy("area_id", "cy", "cx").agg(
        F.collect_list("e").alias("edges"), F.sum("met").alias("met")
    )
    leftwards = Window.partitionBy("area_id", "cy").orderBy(F.desc("cx"))
    beyond = F.coalesce(F.sum("met").over(leftwards.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = own.withColumn("beyond", beyond).withColumn("next", F.lead("cx").over(leftwards))
    odd = lambda n: F.pmod(n, F.lit(2)) == 1
    bare = runs.filter(odd(F.col("beyond") + F.col("met")) & (F.col("next") < F.col("cx") - 1)).select(
        "area_id", F.explode(F.sequence(F.col("next") + 1, F.col("cx") - 1)).alias("cx"), "cy",
        F.array().cast(dict(own.dtypes)["edges"]).alias("edges"), F.lit(True).alias("corner_inside"),
    )
    return runs.select("area_id", "cx", "cy", "edges", odd(F.col("beyond")).alias("corner_inside")).unionByName(bare)


def cells_bytes(cells: DataFrame) -> int:
    """Measured size of a table of cells: four doubles per edge and a few fields per cell."""
    seen = cells.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.size("edges")), F.lit(0)).alias("edges")).first()
    return 96 * seen["n"] + 48 * seen["edges"]


def points_within(
    points: DataFrame,
    areas: DataFrame,
    cell: float,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Every (point, area) pair where the area contains the point (columns x, y).

    The table of cells is built once and its edges are counted; it is broadcast only if it fits. A crowded cell is spread over several tasks by salting its points and repeating its few areas.
    Points are dealt over tasks by their number, as a small file of them would be one task.
    """
    located = spread(points, POINTS_PER_TASK).withColumns({"cx": G.cell(F.col("x"), cell), "cy": G.cell(F.col("y"), cell)})
    cells = durable(area_cells(areas, cell))
    if cells_bytes(cells) <= broadcast_bytes:
        pairs = located.join(F.broadcast(cells), ["cx", "cy"])
    else:
        hot = F.broadcast(hot_keys(located.dropna(subset=["cx", "cy"]), ["cx", "cy"], hot_rows))
        salt = F.pmod(F.spark_partition_id(), F.coalesce(F.col("_salts"), F.lit(1)))
        left = located.join(hot, ["cx", "cy"], "left").withColumn("_salt", salt).drop("_salts")
        copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))
        right = cells.join(hot, ["cx", "cy"], "left").withColumn("_salt", copies).drop("_salts")
        pairs = left.join(right, ["cx", "cy", "_salt"]).drop("_salt")
    inside = G.inside_cell(*[F.col(c) for c in ("corner_inside", "edges", "x", "y", "cx", "cy")], cell)
    return pairs.filter(inside).drop("edges", "corner_inside", "cx", "cy")


def areas_touching(left: DataFrame, right: DataFrame, cell: float, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(left_id, right_id, boundaries_meet) for every pair of areas (area_id, rings) that share a point.

    Boundaries are compared edge by edge within the cells that both touch. Where no edges meet, a whole ring lies
    inside the other area or outside it, so one corner of each ring is looked up there, both ways. Holes count as
    outside, and areas that merely touch share a point.
    """
    keys = ["area_id", "cx", "cy"]

    def edge_cells(areas: DataFrame, name: str) -> DataFrame:
        edges = areas.select("area_id", F.explode(G.edges(F.col("rings"))).alias("e"))
        own = _touched(edges, ["area_id"], cell).groupBy(*keys).agg(F.collect_list("e").alias(f"{name}_edges"))
        return own.withColumnRenamed("area_id", f"{name}_id")

    def corners(areas: DataFrame, name: str) -> DataFrame:
        first = areas.select(F.col("area_id").alias(f"{name}_id"), F.explode("rings").alias("ring")).filter(F.size("ring") > 0)
        at = F.element_at("ring", 1)
        return first.select(f"{name}_id", at["x"].alias("x"), at["y"].alias("y"))

    meet = F.exists("left_edges", lambda a: F.exists("right_edges", lambda b: G.edges_meet(a, b)))
    crossing = (
        edge_cells(left, "left").join(edge_cells(right, "right"), ["cx", "cy"]).filter(meet)
        .select("left_id", "right_id", F.lit(True).alias("boundaries_meet"))
    )
    within = [
        points_within(corners(a, n), b, cell, broadcast_bytes).select(F.col(f"{n}_id"), F.col("area_id").alias(f"{m}_id"))
        for a, n, b, m in ((left, "left", right, "right"), (right, "right", left, "left"))
    ]
    nested = within[0].unionByName(within[1]).withColumn("boundaries_meet", F.lit(False))
    return crossing.unionByName(nested).groupBy("left_id", "right_id").agg(F.max("boundaries_meet").alias("boundaries_meet"))


def buildings_by_area(
    buildings: DataFrame,
    areas: DataFrame,
    cell: float,
    level: int = 3,
    **join_options,
) -> DataFrame:
    """(admin_area_id, admin_area_name, building_count, total_area_m2); empty areas show zero.

    A building belongs to the areas that contain the middle of its footprint.
    """
    named = named_areas(areas, level)
    usable = buildings.filter(F.size("rings") > 0)
    middle = G.centroid(F.element_at("rings", 1))
    points = usable.select(
        "building_id", F.coalesce("area_m2", F.lit(0.0)).alias("area_m2"), middle["x"].alias("x"), middle["y"].alias("y")
    )
    counted = points_within(points, named, cell, **join_options).groupBy("area_id").agg(
        F.count(F.lit(1)).alias("building_count"), F.sum("area_m2").alias("total_area_m2")
    )
    return (
        named.select("area_id", "admin_area_name")
        .join(counted, "area_id", "left")
        .fillna({"building_count": 0, "total_area_m2": 0.0})
        .withColumnRenamed("area_id", "admin_area_id")
    )


def admin_columns(columns: Sequence[str], level: int) -> tuple[str | None, str]:
    """Which columns hold an area's id (none, if there is none) and its name, by the usual spellings."""
    ids = [f"gid_{level}", f"GID_{level}", "gid_3", "GID_3", "area_id"]
    names = [f"NAME_{level}", f"name_{level}", "district", "District", "NAME_3", "name_3", "county", "area_name"]
    found = [next((c for c in wanted if c in columns), None) for wanted in (ids, names)]
    if found[1] is None:
        raise ValueError(f"no name column for admin level {level} among {list(columns)}")
    return found[0], found[1]


def named_areas(areas: DataFrame, level: int = 3) -> DataFrame:
    """(area_id, admin_area_name, rings). Areas without an id column are numbered by name and outline, whatever
    partitions they come in."""
    id_col, name_col = admin_columns(areas.columns, level)
    named = areas.select(*([F.col(id_col).alias("area_id")] if id_col else []), F.col(name_col).alias("admin_area_name"), "rings")
    if id_col:
        return named
    outline = F.sha2(F.to_json("rings"), 256)
    numbers = row_numbers(named.withColumn("_outline", outline), ["admin_area_name", "_outline"], "area_id").drop("_outline")
    return numbers.withColumn("area_id", F.col("area_id").cast("string"))
