"""Planar geometry as Catalyst expressions over arrays of edges."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a buffered point has 16 segments per quadrant.
BUFFER_SIDES = 64


def as_double(col: Column) -> Column:
    return col.cast("double")


def open_ring(ring: Column) -> Column:
    """The ring without a repeated last point."""
    closed = (F.size(ring) > 1) & (F.get(ring, F.lit(0)) == F.get(ring, F.size(ring) - 1))
    return F.when(closed, F.slice(ring, F.lit(1), F.size(ring) - 1)).otherwise(ring)


def ring_edges(ring: Column) -> Column:
    """Edges (x1, y1, x2, y2) of a ring of points, in ring order."""
    points = open_ring(ring)
    rest = F.concat(F.slice(points, F.lit(2), F.size(points) - 1), F.slice(points, 1, 1))
    return F.zip_with(
        points,
        rest,
        lambda p, q: F.struct(
            as_double(p["x"]).alias("x1"),
            as_double(p["y"]).alias("y1"),
            as_double(q["x"]).alias("x2"),
            as_double(q["y"]).alias("y2"),
        ),
    )


def edge_sum(edges: Column, term) -> Column:
    return F.aggregate(edges, F.lit(0.0), lambda acc, e: acc + term(e))


def signed_area(edges: Column) -> Column:
    """Positive for counter-clockwise rings."""
    return edge_sum(edges, lambda e: e["x1"] * e["y2"] - e["x2"] * e["y1"]) / 2


def ring_centroid(edges: Column) -> Column:
    area = signed_area(edges)

    def cross(e: Column) -> Column:
        return e["x1"] * e["y2"] - e["x2"] * e["y1"]

    return F.struct(
        F.try_divide(edge_sum(edges, lambda e: (e["x1"] + e["x2"]) * cross(e)), 6 * area).alias("x"),
        F.try_divide(edge_sum(edges, lambda e: (e["y1"] + e["y2"]) * cross(e)), 6 * area).alias("y"),
    )


def ring_bounds(edges: Column) -> Column:
    xs = F.transform(edges, lambda e: e["x1"])
    ys = F.transform(edges, lambda e: e["y1"])
    return F.struct(
        F.array_min(xs).alias("x0"),
        F.array_min(ys).alias("y0"),
        F.array_max(xs).alias("x1"),
        F.array_max(ys).alias("y1"),
    )


def crosses(e: Column, x: Column, y: Column) -> Column:
    spans = (e["y1"] > y) != (e["y2"] > y)
    slope = F.try_divide((e["x2"] - e["x1"]) * (y - e["y1"]), e["y2"] - e["y1"])
    return spans & (x < slope + e["x1"])


def touches(e: Column, x: Column, y: Column) -> Column:
    cross = (e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"])
    return (
        (cross == 0)
        & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
        & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))
    )


def contains(edges: Column, x: Column, y: Column) -> Column:
    """Strict containment: a point on the boundary is outside."""
    x, y = as_double(x), as_double(y)
    crossings = F.size(F.filter(edges, lambda e: crosses(e, x, y)))
    on_edge = F.exists(edges, lambda e: touches(e, x, y))
    return (crossings % 2 == 1) & ~on_edge


def in_buffered_point(dx: Column, dy: Column, radius: float) -> Column:
    """Strictly inside the regular 64-gon with a corner on the positive x axis."""
    sector = 2 * math.pi / BUFFER_SIDES
    angle = F.pmod(F.atan2(dy, dx), F.lit(sector)) - sector / 2
    reach = F.sqrt(dx * dx + dy * dy) * F.cos(angle)
    return reach < radius * math.cos(sector / 2) - 1e-9


def buffered_point_wkt(x: Column, y: Column, radius: float) -> Column:
    """The 64-gon as WKT text, closed."""
    step = 2 * math.pi / BUFFER_SIDES
    corners = F.transform(
        F.sequence(F.lit(0), F.lit(BUFFER_SIDES)),
        lambda k: F.concat_ws(
            " ",
            F.round(x + radius * F.cos(-k * step), 6).cast("string"),
            F.round(y + radius * F.sin(-k * step), 6).cast("string"),
        ),
    )
    return F.concat(F.lit("POLYGON (("), F.array_join(corners, ", "), F.lit("))"))


def parse_wkt_ring(text: Column) -> Column:
    """Outer ring of a POLYGON text as an array of points."""
    body = F.regexp_extract(text, r"\(\(([^)]*)\)", 1)
    return F.transform(
        F.split(body, r"\s*,\s*"),
        lambda pair: F.struct(
            F.split(F.trim(pair), r"\s+")[0].cast("double").alias("x"),
            F.split(F.trim(pair), r"\s+")[1].cast("double").alias("y"),
        ),
    )


def ring_wkt(ring: Column) -> Column:
    points = open_ring(ring)
    closed = F.concat(points, F.slice(points, 1, 1))
    pairs = F.transform(
        closed,
        lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string")),
    )
    return F.concat(F.lit("POLYGON (("), F.array_join(pairs, ", "), F.lit("))"))


def buffer_reach(e: Column, x: Column, y: Column, side: float) -> Column:
    """Buffer width at which this edge, or the corner at its end, reaches the point.

    ``side`` is 1 for points outside the polygon and -1 for points inside; NULL if
    neither covers the point. Corners are bevelled: within the wedge of a corner
    the offset polygon is cut straight between the two offset edges, so the width
    that reaches a point there is 2 (p - v).(n1 + n2) / |n1 + n2|^2.
    """
    along = (x - e["x1"]) * e["ux"] + (y - e["y1"]) * e["uy"]
    away = side * ((x - e["x1"]) * e["nx"] + (y - e["y1"]) * e["ny"])
    flat = F.when(along.between(F.lit(0.0), e["len"]) & (away >= 0), away)
    past = (x - e["x2"]) * e["ux"] + (y - e["y2"]) * e["uy"] >= 0
    before = (x - e["x2"]) * e["vx"] + (y - e["y2"]) * e["vy"] <= 0
    lean = side * ((x - e["x2"]) * e["sx"] + (y - e["y2"]) * e["sy"])
    cut = F.try_divide(2 * lean, e["sx"] * e["sx"] + e["sy"] * e["sy"])
    corner = F.when(past & before & (side * e["turn"] > 0) & (lean >= 0), cut)
    return F.least(flat, corner)


def segment_gap(e: Column, x: Column, y: Column) -> Column:
    """Euclidean distance from a point to an edge."""
    dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
    t = F.try_divide((x - e["x1"]) * dx + (y - e["y1"]) * dy, dx * dx + dy * dy)
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(t, F.lit(0.0))))
    return F.sqrt(F.pow(x - e["x1"] - t * dx, 2) + F.pow(y - e["y1"] - t * dy, 2))
