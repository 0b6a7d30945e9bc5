"""Polygon maths as column expressions.

A geometry is ``rings``: an array of rings, each an array of points (x, y). The rings of a polygon's
holes and of further polygons are simply listed too: all tests below count edges, so a hole turns
inside into outside by itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

RINGS_TYPE = "array<array<struct<x:double,y:double>>>"

# Fixed value: metres per degree of latitude on a sphere of radius 6371008.8 m.
METRES_PER_DEGREE = 111195.07973436875


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def edges(rings: Column) -> Column:
    """All edges of all rings; a ring that does not end where it starts is closed."""
    return F.flatten(F.transform(rings, _ring_edges))


def _ring_edges(ring: Column) -> Column:
    def pairs(closed: Column) -> Column:
        n = F.size(closed) - 1
        return F.zip_with(
            F.slice(closed, F.lit(1), n),
            F.slice(closed, F.lit(2), n),
            lambda a, b: F.struct(a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")),
        )

    return _once(_once(ring, lambda r: F.concat(r, F.slice(r, 1, 1))), pairs)


def is_closed(ring: Column) -> Column:
    """First point equals last, with at least a triangle in between."""
    return (F.size(ring) >= 4) & (F.element_at(ring, 1) == F.element_at(ring, -1))


def bounds(rings: Column) -> Column:
    pts = F.flatten(rings)
    xs, ys = F.transform(pts, lambda p: p["x"]), F.transform(pts, lambda p: p["y"])
    return F.struct(
        F.array_min(xs).alias("x_min"), F.array_min(ys).alias("y_min"), F.array_max(xs).alias("x_max"), F.array_max(ys).alias("y_max")
    )


def ring_area(ring: Column) -> Column:
    """Shoelace area of one ring in the units of its coordinates, without sign."""
    twice = F.aggregate(
        _ring_edges(ring), F.lit(0.0), lambda acc, e: acc + (e["x1"] * e["y2"] - e["x2"] * e["y1"])
    )
    return F.abs(twice) / 2.0


def ring_area_m2(ring: Column) -> Column:
    """Area in square metres of a small ring given in degrees of longitude and latitude.

    Coordinates are first moved to the ring's own corner and scaled to metres there, which keeps the
    small differences of the shoelace sum exact enough.
    """
    def from_corner(ring: Column) -> Column:
        ys = F.transform(ring, lambda p: p["y"])
        first = F.element_at(ring, 1)
        y_mid = (F.array_min(ys) + F.array_max(ys)) / 2
        kx = F.lit(METRES_PER_DEGREE) * F.cos(F.radians(y_mid))
        base = F.struct(first["x"].alias("x"), first["y"].alias("y"), kx.alias("kx"))
        return _once(
            base,
            lambda b: F.transform(ring, lambda p: point((p["x"] - b["x"]) * b["kx"], (p["y"] - b["y"]) * F.lit(METRES_PER_DEGREE))),
        )

    return ring_area(_once(ring, from_corner))


def centroid(ring: Column) -> Column:
    """Mean of the ring's distinct corners."""
    def mean(corners: Column) -> Column:
        n = F.size(corners)
        return point(
            F.aggregate(corners, F.lit(0.0), lambda a, p: a + p["x"]) / n,
            F.aggregate(corners, F.lit(0.0), lambda a, p: a + p["y"]) / n,
        )

    return _once(_once(ring, lambda r: F.when(is_closed(r), F.slice(r, F.lit(1), F.size(r) - 1)).otherwise(r)), mean)


def cell(v: Column, size: float | Column) -> Column:
    return F.floor(v / size).cast("long")


def height_met(e: Column, y: Column) -> Column:
    """Does the edge cross the line at height ``y``? Its lower end belongs to it, its upper end does not."""
    return (e["y1"] > y) != (e["y2"] > y)


def met_at(e: Column, y: Column) -> Column:
    """Where along x an edge is at height ``y``."""
    return (e["x2"] - e["x1"]) * (y - e["y1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0)) + e["x1"]


def _column_at(e: Column, y: Column, size: float) -> Column:
    """The column of cells that an edge is in at height ``y``, or at the end that is nearest to it."""
    lower, upper = F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"])
    at_end = F.when((y < lower) == (e["y1"] < e["y2"]), e["x1"]).otherwise(e["x2"])
    return cell(F.when((y >= lower) & (y < upper), met_at(e, y)).otherwise(at_end), size)


def inside_cell(corner_inside: Column, edge_list: Column, x: Column, y: Column, cx: Column, cy: Column, size: float) -> Column:
    """Is the point (x, y) of cell (cx, cy) inside, told by the edges that touch the cell alone?

    ``corner_inside`` says whether the cell's lower right corner is, by a ray to the right. A ray from the point
    crosses the cell's own edges first. What it crosses beyond the cell's right side differs from what the corner's
    ray crosses by the edges that pass that side between the two heights, and these touch the cell as well. Every
    place where an edge meets a height is rounded to its column in one way, so the parts always add up to the count
    that one ray over all edges gives.
    """
    bottom = cy * F.lit(float(size))

    def odd(e: Column) -> Column:
        within = height_met(e, y) & (x < met_at(e, y)) & (cell(met_at(e, y), size) == cx)
        level = e["y1"] == e["y2"]
        passes = F.when(level, (e["y1"] > bottom) & (e["y1"] <= y) & ((cell(e["x1"], size) > cx) != (cell(e["x2"], size) > cx))).otherwise(
            (_column_at(e, y, size) > cx) != (_column_at(e, bottom, size) > cx)
        )
        return F.coalesce(within, F.lit(False)).cast("int") + F.coalesce(passes, F.lit(False)).cast("int")

    return F.aggregate(edge_list, corner_inside.cast("int"), lambda n, e: n + odd(e)) % 2 == 1


def _turn(ax: Column, ay: Column, bx: Column, by: Column, px: Column, py: Column) -> Column:
    return F.signum((bx - ax) * (py - ay) - (by - ay) * (px - ax))


def edges_meet(a: Column, b: Column) -> Column:
    """Do two edges share a point, their ends included?"""
    t1 = _turn(a["x1"], a["y1"], a["x2"], a["y2"], b["x1"], b["y1"])
    t2 = _turn(a["x1"], a["y1"], a["x2"], a["y2"], b["x2"], b["y2"])
    t3 = _turn(b["x1"], b["y1"], b["x2"], b["y2"], a["x1"], a["y1"])
    t4 = _turn(b["x1"], b["y1"], b["x2"], b["y2"], a["x2"], a["y2"])

    def overlap(p: str, q: str) -> Column:
        return (F.least(a[p], a[q]) <= F.greatest(b[p], b[q])) & (F.least(b[p], b[q]) <= F.greatest(a[p], a[q]))

    # edges on one line only meet if their boxes do
    return (t1 * t2 <= 0) & (t3 * t4 <= 0) & overlap("x1", "x2") & overlap("y1", "y2")
