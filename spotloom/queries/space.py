"""Spatial joins, region membership and infiltration."""

import math

from pyspark.sql import functions as F

from .. import domain as d
from ..functions import geometry as geo
from ..functions.numeric import r6, to_micron
from ..operators import spatial as sp
from ..registry import query

R = d.SPOT_RADIUS
_SECTOR = 2 * math.pi / 64

_IN_SPOT = f"""in_spot AS (
    SELECT c.cell_ids, max(s.barcode) AS barcode
    FROM cells c JOIN spots s
      ON c.cell_x BETWEEN pxl_col_in_fullres - {R} AND pxl_col_in_fullres + {R}
     AND c.cell_y BETWEEN pxl_row_in_fullres - {R} AND pxl_row_in_fullres + {R}
    WHERE sqrt((cell_x - pxl_col_in_fullres) ** 2 + (cell_y - pxl_row_in_fullres) ** 2)
        * cos((atan2(cell_y - pxl_row_in_fullres, cell_x - pxl_col_in_fullres) + 2 * pi()) % {_SECTOR!r}::double
              - {_SECTOR / 2!r}::double)
        < {R * math.cos(_SECTOR / 2)!r}::double - 1e-9::double
    GROUP BY 1)"""


def _inside(points: str, key: str, x: str, y: str) -> str:
    """Strict ray-cast membership of every point in every region."""
    return f"""{points}_in AS (
    SELECT p.{key}, e.region_class, e.region_name
    FROM {points} p JOIN (
        SELECT region_class, region_name, min(x1) AS bx0, max(x1) AS bx1, min(y1) AS by0, max(y1) AS by1
        FROM edges GROUP BY 1, 2) b ON p.{x} BETWEEN bx0 AND bx1 AND p.{y} BETWEEN by0 AND by1
    JOIN edges e ON e.region_name = b.region_name
    GROUP BY 1, 2, 3
    HAVING count(*) FILTER (WHERE (y1 > p.{y}) <> (y2 > p.{y})
                AND p.{x} < (x2 - x1) * (p.{y} - y1) / (y2 - y1) + x1) % 2 = 1)"""


_CELLS_IN = _inside("cells", "cell_ids", "cell_x", "cell_y")
_SPOTS_IN = _inside("spots", "barcode", "pxl_col_in_fullres", "pxl_row_in_fullres")

_LEVELS = (
    _CELLS_IN
    + f""",
walls AS (
    SELECT *, (x2 - x1) / len AS ux, (y2 - y1) / len AS uy
    FROM (SELECT *, sqrt((x2 - x1) ** 2 + (y2 - y1) ** 2) AS len FROM edges)),
corners AS MATERIALIZED (
    SELECT *, coalesce(lead(ux) OVER w, first_value(ux) OVER w) AS vx,
           coalesce(lead(uy) OVER w, first_value(uy) OVER w) AS vy
    FROM walls WINDOW w AS (PARTITION BY region_name ORDER BY i)),
near AS MATERIALIZED (
    SELECT c.*, b.region_class, b.region_name,
           CASE WHEN ci.cell_ids IS NULL THEN 1.0 ELSE -1.0 END::double AS side
    FROM cells c JOIN (
        SELECT region_class, region_name, min(x1) AS bx0, max(x1) AS bx1, min(y1) AS by0, max(y1) AS by1
        FROM edges GROUP BY 1, 2) b
      ON cell_x BETWEEN bx0 - {4 * d.STEP} AND bx1 + {4 * d.STEP}
     AND cell_y BETWEEN by0 - {4 * d.STEP} AND by1 + {4 * d.STEP}
    LEFT JOIN cells_in ci ON ci.cell_ids = c.cell_ids AND ci.region_name = b.region_name),
reach AS (
    SELECT cell_ids, region_name, side,
        CASE WHEN (cell_x - x1) * ux + (cell_y - y1) * uy BETWEEN 0 AND len
              AND side * ((cell_x - x1) * uy - (cell_y - y1) * ux) >= 0
             THEN side * ((cell_x - x1) * uy - (cell_y - y1) * ux) END AS flat,
        CASE WHEN (cell_x - x2) * ux + (cell_y - y2) * uy >= 0
              AND (cell_x - x2) * vx + (cell_y - y2) * vy <= 0
              AND side * (ux * vy - uy * vx) > 0
              AND side * ((cell_x - x2) * (uy + vy) - (cell_y - y2) * (ux + vx)) >= 0
             THEN 2 * side * ((cell_x - x2) * (uy + vy) - (cell_y - y2) * (ux + vx))
                  / ((ux + vx) ** 2 + (uy + vy) ** 2) END AS cut
    FROM near JOIN corners USING (region_class, region_name)),
dist AS MATERIALIZED (
    SELECT cell_ids, region_name, round(any_value(side) * min(least(flat, cut)), 9) AS dist
    FROM reach GROUP BY 1, 2),
levels AS (
    SELECT region_class, region_name, cell_ids, cell_type,
           ((floor(dist / {d.STEP}) + 1) * {d.STEP})::int AS infilt_level
    FROM dist JOIN near USING (cell_ids, region_name) WHERE dist < {4 * d.STEP}),
counts AS (
    SELECT region_class, region_name, infilt_level AS level, cell_type, count(*) AS abundance
    FROM levels GROUP BY ALL)"""
)


@query(
    "space_cells_to_spots",
    d.sql(
        "cells", "spots", extra=_IN_SPOT,
        body="SELECT cell_ids, cell_x, cell_y, barcode FROM cells LEFT JOIN in_spot USING (cell_ids)",
    ),
)
def space_cells_to_spots(spark, sf):
    cells = d.spread(d.cells(spark, sf).select("cell_ids", "cell_x", "cell_y"))
    return sp.assign_cells_to_spots(cells, d.spots(spark, sf), R)


@query(
    "space_contained_cells",
    d.sql(
        "cells", "spots", extra=_IN_SPOT,
        body="""SELECT barcode, coalesce(n, 0) AS num_contained_cells FROM spots
LEFT JOIN (SELECT barcode, count(*) AS n FROM in_spot GROUP BY 1) USING (barcode)""",
    ),
)
def space_contained_cells(spark, sf):
    cells = d.spread(d.cells(spark, sf).select("cell_ids", "cell_x", "cell_y"))
    spots = d.spots(spark, sf)
    placed = sp.assign_cells_to_spots(cells, spots, R)
    return sp.contained_cells(placed, spots.select("barcode"))


@query(
    "space_spot_polygons",
    d.sql(
        "spots",
        body=f"""SELECT barcode, round(max(px), 4) AS right_most, round(min(py), 4) AS top_most, count(*) AS corners
FROM (SELECT barcode, pxl_col_in_fullres + {R} * cos(-k * {_SECTOR!r}::double) AS px,
             pxl_row_in_fullres + {R} * sin(-k * {_SECTOR!r}::double) AS py
      FROM spots, range(0, 65) t(k)) GROUP BY 1""",
    ),
)
def space_spot_polygons(spark, sf):
    """WKT polygons of the spots, read back as rings."""
    text = geo.buffered_point_wkt(F.col("pxl_col_in_fullres"), F.col("pxl_row_in_fullres"), R)
    ring = geo.parse_wkt_ring(F.col("spot_polygon"))
    return (
        d.spots(spark, sf)
        .select("barcode", text.alias("spot_polygon"))
        .select(
            "barcode",
            F.round(F.array_max(F.transform(ring, lambda p: p["x"])), 4).alias("right_most"),
            F.round(F.array_min(F.transform(ring, lambda p: p["y"])), 4).alias("top_most"),
            F.size(ring).cast("long").alias("corners"),
        )
    )


@query(
    "space_area_quantile_filter",
    d.sql(
        "cells",
        body="""SELECT cell_ids, area FROM cells, (
    SELECT quantile_cont(area, 0.01) AS lo, quantile_cont(area, 0.99) AS hi FROM cells)
WHERE area > lo AND area < hi""",
    ),
)
def space_area_quantile_filter(spark, sf):
    return sp.filter_by_area(d.cells(spark, sf)).select("cell_ids", "area")


@query(
    "space_area_zscore_filter",
    d.sql(
        "cells",
        body="""SELECT cell_ids, area FROM cells, (SELECT avg(area) AS m, stddev_pop(area) AS s FROM cells)
WHERE abs((area - m) / s) < 3""",
    ),
)
def space_area_zscore_filter(spark, sf):
    return sp.filter_by_area(d.cells(spark, sf), "zscore").select("cell_ids", "area")


@query(
    "space_tissue_box",
    d.sql(
        "spots",
        body="""SELECT greatest(min(pxl_row_in_fullres) - 64, 0) AS y0, least(max(pxl_row_in_fullres) + 64, 100000) AS y1,
    greatest(min(pxl_col_in_fullres) - 64, 0) AS x0, least(max(pxl_col_in_fullres) + 64, 3100) AS x1
FROM spots WHERE in_tissue = 1 AND pxl_row_in_fullres BETWEEN 0 AND 99999 AND pxl_col_in_fullres BETWEEN 0 AND 3099""",
    ),
)
def space_tissue_box(spark, sf):
    return sp.tissue_box(d.spots(spark, sf), 64, 100000, 3100)


@query(
    "space_region_cells",
    d.sql(
        "spots", "regions", "cells", extra=_CELLS_IN,
        body="SELECT region_class, region_name, cell_ids FROM cells_in",
    ),
)
def space_region_cells(spark, sf):
    cells = d.spread(d.cells(spark, sf).select("cell_ids", "cell_x", "cell_y"))
    hits = sp.region_members(cells, d.regions(spark, sf), "cell_ids", "cell_x", "cell_y")
    return hits.select("region_class", "region_name", "cell_ids")


@query(
    "space_region_spots",
    d.sql(
        "spots", "regions", extra=_SPOTS_IN,
        body="SELECT region_class, region_name, barcode FROM spots_in",
    ),
)
def space_region_spots(spark, sf):
    spots = d.spots(spark, sf)
    hits = sp.region_members(
        spots, d.regions(spark, sf), "barcode", "pxl_col_in_fullres", "pxl_row_in_fullres"
    )
    return hits.select("region_class", "region_name", "barcode")


@query(
    "space_region_sizes",
    d.sql(
        "spots", "regions", "cells", extra=_CELLS_IN + ",\n" + _SPOTS_IN,
        body="""SELECT region_class, region_name, coalesce(nc, 0) AS num_cells, num_spots
FROM (SELECT region_class, region_name, count(*) AS num_spots FROM spots_in GROUP BY 1, 2 HAVING count(*) > 1)
LEFT JOIN (SELECT region_name, count(*) AS nc FROM cells_in GROUP BY 1) USING (region_name)""",
    ),
)
def space_region_sizes(spark, sf):
    cells = d.spread(d.cells(spark, sf).select("cell_ids", "cell_x", "cell_y"))
    return sp.region_sizes(cells, d.spots(spark, sf), d.regions(spark, sf))


@query(
    "space_cluster_sizes",
    d.sql(
        "spots", "assigned",
        body="""SELECT cluster, coalesce(sum(n), 0)::bigint AS num_cells, count(*) AS num_spots FROM spots
LEFT JOIN (SELECT barcode, count(*) AS n FROM assigned GROUP BY 1) USING (barcode) GROUP BY 1""",
    ),
)
def space_cluster_sizes(spark, sf):
    return sp.cluster_sizes(d.assigned(spark, sf), d.spots(spark, sf))


@query(
    "space_region_shapes",
    d.sql(
        "spots", "regions",
        body="""SELECT region_name, round(sum(x1 * y2 - x2 * y1) / 2, 3) AS area,
    round(sum((x1 + x2) * (x1 * y2 - x2 * y1)) / (3 * sum(x1 * y2 - x2 * y1)), 3) AS cx,
    round(sum((y1 + y2) * (x1 * y2 - x2 * y1)) / (3 * sum(x1 * y2 - x2 * y1)), 3) AS cy
FROM edges GROUP BY 1""",
    ),
)
def space_region_shapes(spark, sf):
    edged = d.regions(spark, sf).withColumn("edges", geo.ring_edges(F.col("ring")))
    centre = geo.ring_centroid(F.col("edges"))
    return edged.select(
        "region_name",
        F.round(geo.signed_area(F.col("edges")), 3).alias("area"),
        F.round(centre["x"], 3).alias("cx"),
        F.round(centre["y"], 3).alias("cy"),
    )


@query(
    "space_micron_coordinates",
    d.sql("cells", body="SELECT cell_ids, round(cell_x * (65.0::double / 80.0::double), 6) AS x_um FROM cells"),
)
def space_micron_coordinates(spark, sf):
    return d.cells(spark, sf).select("cell_ids", r6(to_micron(F.col("cell_x"), 80.0)).alias("x_um"))


def _levels(spark, sf):
    return sp.infiltration_levels(d.spread(d.cells(spark, sf)), d.regions(spark, sf), d.STEP)


@query(
    "infiltration_levels",
    d.sql(
        "spots", "regions", "cells", extra=_LEVELS,
        body="SELECT region_class, region_name, cell_ids, infilt_level FROM levels",
    ),
)
def infiltration_levels(spark, sf):
    return _levels(spark, sf).select("region_class", "region_name", "cell_ids", "infilt_level")


@query(
    "infiltration_abundance",
    d.sql(
        "spots", "regions", "cells", extra=_LEVELS,
        body=f"""SELECT *, ((upper_bound + lower_bound) / 2)::double AS mid_point FROM (
SELECT region_class, region_name, level, cell_type, abundance,
    round(abundance / sum(abundance) OVER (PARTITION BY region_name, level)::double, 6) AS proportion,
    trunc(level * (65.0::double / {d.SPOT_DIAMETER}))::int AS upper_bound,
    trunc((level - {d.STEP}) * (65.0::double / {d.SPOT_DIAMETER}))::int AS lower_bound
FROM counts)""",
    ),
)
def infiltration_abundance(spark, sf):
    table = sp.infiltration_table(_levels(spark, sf), d.SPOT_DIAMETER, d.STEP)
    return table.withColumn("proportion", r6(F.col("proportion")))


@query(
    "infiltration_by_cell_type",
    d.sql(
        "spots", "regions", "cells", extra=_LEVELS,
        body="""SELECT l.region_class, l.region_name, l.level, t.cell_type, coalesce(abundance, 0) AS abundance
FROM (SELECT DISTINCT region_class, region_name, level FROM counts) l
JOIN (SELECT DISTINCT region_name, cell_type FROM counts) t USING (region_name)
LEFT JOIN counts c ON c.region_name = l.region_name AND c.level = l.level AND c.cell_type = t.cell_type""",
    ),
)
def infiltration_by_cell_type(spark, sf):
    return sp.infiltration_grid(_levels(spark, sf))


_TEST_SUMS = """,
gaps AS (
    SELECT region_class, region_name, cell_type, ls[1] - ls[2] AS gap FROM (
        SELECT region_class, region_name, cell_type, list_sort(list(DISTINCT level), 'DESC') AS ls
        FROM counts GROUP BY 1, 2, 3)),
sums AS (
    SELECT g.region_class, g.region_name, g.cell_type,
        coalesce(sum(abundance) FILTER (WHERE c.cell_type = g.cell_type AND level <= -gap), 0)::double AS x1,
        coalesce(sum(abundance) FILTER (WHERE c.cell_type = g.cell_type AND level > gap), 0)::double AS x2,
        coalesce(sum(abundance) FILTER (WHERE level <= -gap), 0)::double AS n1,
        coalesce(sum(abundance) FILTER (WHERE level > gap), 0)::double AS n2
    FROM gaps g JOIN counts c USING (region_name) GROUP BY 1, 2, 3)"""


@query(
    "infiltration_test",
    d.sql(
        "spots", "regions", "cells",
        extra=_LEVELS + _TEST_SUMS,
        body="""SELECT *, CASE WHEN n1 > 0 AND n2 > 0 THEN
    round((x1 / n1 - x2 / n2) / nullif(sqrt((x1 + x2) / (n1 + n2) * (1 - (x1 + x2) / (n1 + n2)) * (1 / n1 + 1 / n2)), 0), 6)
    ELSE 0.0::double END AS z FROM sums""",
    ),
)
def infiltration_test(spark, sf):
    table = sp.infiltration_table(_levels(spark, sf), d.SPOT_DIAMETER, d.STEP)
    tested = sp.infiltration_test(table)
    return tested.withColumn("z", r6(F.col("z"))).drop("p", "significant")


def _slides(cells):
    return cells.withColumn("slide", F.col("cell_ids") % 2)


def _on_both(df):
    return df.withColumn("slide", F.explode(F.array(F.lit(0).cast("long"), F.lit(1).cast("long"))))


@query(
    "infiltration_significance",
    d.sql(
        "spots", "regions", "cells",
        extra=_LEVELS + _TEST_SUMS,
        body="""SELECT region_class, region_name, cell_type, coalesce(n1 > 0 AND n2 > 0 AND
    abs((x1 / n1 - x2 / n2) / nullif(sqrt((x1 + x2) / (n1 + n2) * (1 - (x1 + x2) / (n1 + n2)) * (1 / n1 + 1 / n2)), 0))
    > 1.959963984540054, false) AS significant FROM sums""",
    ),
)
def infiltration_significance(spark, sf):
    """Types whose share differs between the inside and the outside at p < 0.05."""
    table = sp.infiltration_table(_levels(spark, sf), d.SPOT_DIAMETER, d.STEP)
    return sp.infiltration_test(table).select("region_class", "region_name", "cell_type", "significant")


@query(
    "infiltration_pvalues",
    d.sql(
        "spots", "regions", "cells",
        extra=_LEVELS + _TEST_SUMS + """,
zs AS MATERIALIZED (
    SELECT *, abs((x1 / n1 - x2 / n2)
        / nullif(sqrt((x1 + x2) / (n1 + n2) * (1 - (x1 + x2) / (n1 + n2)) * (1 / n1 + 1 / n2)), 0)) AS z FROM sums)""",
        body=f"""SELECT region_class, region_name, cell_type, CASE WHEN n1 > 0 AND n2 > 0 THEN
    round(2 * ({d.normal_tail_sql("z")}), 6) ELSE 1.0::double END AS p FROM zs""",
    ),
)
def infiltration_pvalues(spark, sf):
    table = sp.infiltration_table(_levels(spark, sf), d.SPOT_DIAMETER, d.STEP)
    return sp.infiltration_test(table).select("region_class", "region_name", "cell_type", r6(F.col("p")).alias("p"))


@query(
    "slides_cells_to_spots",
    d.sql(
        "cells", "spots",
        extra=_IN_SPOT.replace("    WHERE ", "    WHERE c.cell_ids % 2 = s.barcode % 2 AND ", 1),
        body="""SELECT cell_ids % 2 AS slide, cell_ids // 2 AS cell_ids, barcode
FROM cells LEFT JOIN in_spot USING (cell_ids)""",
    ),
)
def slides_cells_to_spots(spark, sf):
    """Two slides with the same cell ids and the same coordinates; each has every other spot."""
    cells = _slides(d.cells(spark, sf)).select(
        "slide", F.expr("cell_ids div 2").alias("cell_ids"), "cell_x", "cell_y"
    )
    spots = d.spots(spark, sf).withColumn("slide", F.col("barcode") % 2)
    return sp.assign_cells_to_spots(cells, spots, R, by=["slide"]).select("slide", "cell_ids", "barcode")


@query(
    "slides_region_cells",
    d.sql(
        "spots", "regions", "cells", extra=_LEVELS,
        body="""SELECT cell_ids % 2 AS slide, region_class, region_name, infilt_level AS level, cell_type,
    count(*) AS abundance
FROM levels GROUP BY 1, 2, 3, 4, 5""",
    ),
)
def slides_region_cells(spark, sf):
    """Infiltration per slide, the regions drawn on both."""
    levels = sp.infiltration_levels(
        _slides(d.spread(d.cells(spark, sf))), _on_both(d.regions(spark, sf)), d.STEP, by=["slide"]
    )
    table = sp.infiltration_table(levels, d.SPOT_DIAMETER, d.STEP, ["slide"])
    return table.select("slide", "region_class", "region_name", "level", "cell_type", "abundance")
