"""Label masks, tiles, segmentation quality and training history."""

from pyspark.sql import functions as F

from .. import domain as d
from .. import schemas
from ..functions.numeric import r6
from ..operators import components as cc
from ..operators import evaluation as ev
from ..operators import history as h
from ..operators import masks as mk
from ..operators import tiles as tl
from ..registry import query
from ..sinks import writers

_PRED = "px AS (SELECT img, y, x, pred_id AS inst_id, pixel_type, intensity FROM masks WHERE pred_id > 0)"


def _pred(spark, sf):
    return mk.foreground(d.masks(spark, sf), "pred_id").select(
        "img", "y", "x", "inst_id", "pixel_type", "intensity"
    )


def _images(spark, sf):
    return d.masks(spark, sf).select("img").distinct().select(
        "img", F.lit(64).alias("height"), F.lit(64).alias("width")
    )


@query(
    "mask_sizes",
    d.sql("masks", extra=_PRED, body="SELECT img, inst_id, count(*) AS size FROM px GROUP BY 1, 2"),
)
def mask_sizes(spark, sf):
    return mk.instance_sizes(_pred(spark, sf))


@query(
    "mask_drop_small",
    d.sql(
        "masks", extra=_PRED,
        body="""SELECT img, y, x, inst_id FROM px WHERE (img, inst_id) IN
    (SELECT (img, inst_id) FROM px GROUP BY img, inst_id HAVING count(*) >= 60)""",
    ),
)
def mask_drop_small(spark, sf):
    return mk.drop_small(_pred(spark, sf), 60).select("img", "y", "x", "inst_id")


@query(
    "mask_remove_listed",
    d.sql(
        "masks", extra=_PRED,
        body="""SELECT img, y, x, inst_id FROM px WHERE (img, inst_id) NOT IN
    (SELECT (img, inst_id) FROM px WHERE intensity > 490000)""",
    ),
)
def mask_remove_listed(spark, sf):
    px = _pred(spark, sf)
    bright = px.filter("intensity > 490000").select("img", "inst_id").distinct()
    return mk.remove_instances(px, bright).select("img", "y", "x", "inst_id")


@query(
    "mask_dense_ids",
    d.sql(
        "masks", extra=_PRED,
        body="""SELECT img, inst_id, dense_rank() OVER (PARTITION BY img ORDER BY inst_id)::int AS new_id
FROM (SELECT DISTINCT img, inst_id FROM px)""",
    ),
)
def mask_dense_ids(spark, sf):
    return mk.dense_ids(_pred(spark, sf))


@query(
    "mask_ids_by_size",
    d.sql(
        "masks", extra=_PRED,
        body="""SELECT img, inst_id, row_number() OVER (PARTITION BY img ORDER BY n DESC, inst_id)::int AS new_id
FROM (SELECT img, inst_id, count(*) AS n FROM px GROUP BY 1, 2)""",
    ),
)
def mask_ids_by_size(spark, sf):
    return mk.dense_ids(_pred(spark, sf), by_size=True)


@query(
    "mask_relabelled",
    d.sql(
        "masks", extra=_PRED,
        body="""SELECT img, y, x, dense_rank() OVER (PARTITION BY img ORDER BY inst_id)::int AS inst_id FROM px""",
    ),
)
def mask_relabelled(spark, sf):
    px = _pred(spark, sf).select("img", "y", "x", "inst_id")
    return mk.relabel(px, mk.dense_ids(px))


@query(
    "mask_instance_info",
    d.sql(
        "masks",
        extra=_PRED + """,
kinds AS (SELECT img, inst_id, CASE WHEN pixel_type = 5 THEN 0 ELSE pixel_type END AS t, y, x FROM px),
votes AS (
    SELECT img, inst_id, t, count(*) AS c,
        row_number() OVER (PARTITION BY img, inst_id ORDER BY (t = 0)::int, count(*) DESC, t) AS rn
    FROM kinds GROUP BY 1, 2, 3)""",
        body="""SELECT k.img, k.inst_id, count(*) AS size, min(y) AS rmin, min(x) AS cmin, max(y) + 1 AS rmax,
    max(x) + 1 AS cmax, round(avg(x), 6) AS centroid_x, round(avg(y), 6) AS centroid_y,
    any_value(v.t)::int AS type, round(any_value(v.c) / (count(*) + 1e-6), 6) AS type_prob
FROM kinds k JOIN votes v ON v.img = k.img AND v.inst_id = k.inst_id AND rn = 1 GROUP BY 1, 2""",
    ),
)
def mask_instance_info(spark, sf):
    kind = F.when(F.col("pixel_type") == 5, 0).otherwise(F.col("pixel_type"))
    info = mk.instance_info(_pred(spark, sf).withColumn("pixel_type", kind))
    return info.select(
        "img", "inst_id", "size", "rmin", "cmin", "rmax", "cmax", "type",
        *[r6(F.col(c)).alias(c) for c in ("centroid_x", "centroid_y", "type_prob")],
    )


@query(
    "mask_block_mean",
    d.sql(
        "masks",
        body="""SELECT img, y // 6 AS y, x // 6 AS x, round(sum(intensity) / 36, 4) AS intensity
FROM masks GROUP BY 1, 2, 3""",
    ),
)
def mask_block_mean(spark, sf):
    small = mk.block_mean(d.masks(spark, sf), 6, "intensity")
    return small.withColumn("intensity", F.round("intensity", 4))


@query(
    "mask_padded_crop",
    d.sql(
        "masks", extra=_PRED,
        body="""SELECT img, y - 8 + 16 AS y, x - 12 + 16 AS x, inst_id FROM px
WHERE y >= 8 AND y < 48 AND x >= 12 AND x < 60""",
    ),
)
def mask_padded_crop(spark, sf):
    px = _pred(spark, sf).select("img", "y", "x", "inst_id")
    return mk.shift(mk.crop(px, 8, 48, 12, 60), 16, 16)


@query(
    "mask_central_crop",
    d.sql(
        "masks", extra=_PRED,
        body="SELECT img, y - 11 AS y, x - 16 AS x, inst_id FROM px WHERE y >= 11 AND y < 52 AND x >= 16 AND x < 48",
    ),
)
def mask_central_crop(spark, sf):
    px = _pred(spark, sf).select("img", "y", "x", "inst_id")
    return mk.central_crop(px, 64, 64, 41, 32)


@query(
    "mask_byte_scale",
    d.sql(
        "masks",
        body="""SELECT img, y, x, floor(intensity / max(intensity) OVER (PARTITION BY img) * 255)::int AS intensity
FROM masks""",
    ),
)
def mask_byte_scale(spark, sf):
    return mk.scale_to_byte(d.masks(spark, sf).select("img", "y", "x", "intensity"), "intensity")


@query(
    "mask_distance_maps",
    d.sql(
        "masks",
        extra=_PRED + """,
st AS (
    SELECT img, inst_id, min(x) - 2 - 1 + floor(avg(x) - (min(x) - 2) + 0.5) AS cx,
           min(y) - 2 - 1 + floor(avg(y) - (min(y) - 2) + 0.5) AS cy,
           min(x) AS lx, max(x) AS hx, min(y) AS ly, max(y) AS hy
    FROM px GROUP BY 1, 2 HAVING count(*) >= 30)""",
        body="""SELECT img, y, x, inst_id,
    round(CASE WHEN x < cx THEN (x - cx) / (cx - lx) WHEN x > cx THEN (x - cx) / (hx - cx) ELSE 0 END, 6) AS h,
    round(CASE WHEN y < cy THEN (y - cy) / (cy - ly) WHEN y > cy THEN (y - cy) / (hy - cy) ELSE 0 END, 6) AS v
FROM px JOIN st USING (img, inst_id)""",
    ),
)
def mask_distance_maps(spark, sf):
    maps = mk.distance_maps(_pred(spark, sf))
    return maps.withColumn("h", r6(F.col("h"))).withColumn("v", r6(F.col("v")))


@query(
    "mask_moment_features",
    d.sql(
        "masks",
        extra=_PRED + """,
mid AS (SELECT img, inst_id, avg(x) AS mx, avg(y) AS my, count(*)::double AS a FROM px GROUP BY 1, 2),
mu AS (
    SELECT img, inst_id, a, sum((y - my) ** 2) AS c20, sum((x - mx) ** 2) AS c02, sum((y - my) * (x - mx)) AS c11,
           sum((y - my) ** 3) AS c30, sum((x - mx) ** 3) AS c03,
           (max(y) - min(y) + 1) * (max(x) - min(x) + 1) AS bb, avg(intensity) AS im
    FROM px JOIN mid USING (img, inst_id) GROUP BY 1, 2, 3),
ev AS (
    SELECT *, (c02 + c20) / a / 2 + sqrt(((c02 - c20) / a / 2) ** 2 + (c11 / a) ** 2) AS l1,
           greatest((c02 + c20) / a / 2 - sqrt(((c02 - c20) / a / 2) ** 2 + (c11 / a) ** 2), 0) AS l2 FROM mu)""",
        body="""SELECT img, inst_id, a::bigint AS area, bb::bigint AS area_bbox, round(a / bb, 6) AS extent,
    round(4 * sqrt(l1), 5) AS axis_major_length, round(4 * sqrt(l2), 5) AS axis_minor_length,
    round(CASE WHEN l1 = 0 THEN 0 ELSE sqrt(1 - l2 / l1) END, 5) AS eccentricity,
    round(c02 / a, 5) AS inertia_tensor_0_0, round(im, 2) AS intensity_mean,
    round((c20 + c02) / (a * a), 6) AS moments_hu_0
FROM ev""",
    ),
)
def mask_moment_features(spark, sf):
    f = mk.moment_features(_pred(spark, sf))
    return f.select(
        "img", "inst_id", "area", "area_bbox", r6(F.col("extent")).alias("extent"),
        *[F.round(c, 5).alias(c) for c in ("axis_major_length", "axis_minor_length", "eccentricity", "inertia_tensor_0_0")],
        F.round("intensity_mean", 2).alias("intensity_mean"),
        r6(F.col("moments_hu_0")).alias("moments_hu_0"),
    )


_QUAD_CASE = "CASE code " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(mk.EULER_8)) + " END"
_CROFTON_CASE = "CASE code " + " ".join(f"WHEN {i} THEN {float(v)!r}::double" for i, v in enumerate(mk.CROFTON_4)) + " END"


@query(
    "mask_pattern_features",
    d.sql(
        "masks",
        extra=_PRED + f""",
quad AS (
    SELECT img, inst_id, y + dy AS y, x + dx AS x, sum(w) AS code
    FROM px, (VALUES (0, 0, 1), (1, 0, 2), (0, 1, 4), (1, 1, 8)) s(dy, dx, w) GROUP BY 1, 2, 3, 4),
q AS (SELECT img, inst_id, sum({_QUAD_CASE})::bigint AS euler_number, sum({_CROFTON_CASE}) AS crofton
      FROM quad GROUP BY 1, 2),
border AS (
    SELECT p.img, p.inst_id, p.y, p.x FROM px p LEFT JOIN px n ON n.img = p.img AND n.inst_id = p.inst_id
      AND abs(n.y - p.y) + abs(n.x - p.x) = 1
    GROUP BY 1, 2, 3, 4 HAVING count(n.y) < 4),
codes AS (
    SELECT b.img, b.inst_id, b.y, b.x, 1 + sum(CASE WHEN n.y IS NULL THEN 0
        WHEN abs(n.y - b.y) + abs(n.x - b.x) = 1 THEN 2 WHEN abs(n.y - b.y) + abs(n.x - b.x) = 2 THEN 10 ELSE 0 END) AS code
    FROM border b LEFT JOIN border n ON n.img = b.img AND n.inst_id = b.inst_id
      AND n.y BETWEEN b.y - 1 AND b.y + 1 AND n.x BETWEEN b.x - 1 AND b.x + 1
    GROUP BY 1, 2, 3, 4),
p AS (
    SELECT img, inst_id, sum(CASE WHEN code IN (5, 7, 15, 17, 25, 27) THEN 1.0 WHEN code IN (21, 33) THEN sqrt(2)
        WHEN code IN (13, 23) THEN (1 + sqrt(2)) / 2 ELSE 0 END) AS perimeter FROM codes GROUP BY 1, 2)""",
        body="""SELECT img, inst_id, euler_number, round(crofton, 5) AS perimeter_crofton, round(perimeter, 5) AS perimeter
FROM q JOIN p USING (img, inst_id)""",
    ),
)
def mask_pattern_features(spark, sf):
    f = mk.pattern_features(_pred(spark, sf))
    return f.select(
        "img", "inst_id", F.col("euler_number").cast("long").alias("euler_number"),
        F.round("perimeter_crofton", 5).alias("perimeter_crofton"),
        F.round("perimeter", 5).alias("perimeter"),
    )


_PARTS = _PRED + """,
walk AS (
    SELECT img, inst_id, y, x, y::bigint * 4294967296 + x AS k FROM px
    UNION
    SELECT p.img, p.inst_id, p.y, p.x, w.k FROM walk w JOIN px p ON p.img = w.img AND p.inst_id = w.inst_id
        AND abs(p.y - w.y) + abs(p.x - w.x) = 1),
part AS (SELECT img, inst_id, y, x, min(k) AS component FROM walk GROUP BY 1, 2, 3, 4)"""


@query(
    "mask_components",
    d.sql(
        "masks", extra=_PARTS,
        body="""SELECT img, inst_id::bigint AS inst_id, component, count(*) AS pixels FROM part GROUP BY 1, 2, 3""",
    ),
)
def mask_components(spark, sf):
    """Parts of every predicted instance (4-connected)."""
    parts = cc.mask_components(_pred(spark, sf).select("img", "y", "x", "inst_id"), tile=32)
    return parts.groupBy("img", "inst_id", "component").agg(F.count("*").alias("pixels"))


@query(
    "mask_polygons",
    d.sql(
        "masks", extra=_PARTS,
        body="""SELECT img, inst_id::bigint AS cell_ids, round(avg(x) + 0.5, 6) AS cell_x, round(avg(y) + 0.5, 6) AS cell_y,
    count(*) AS area, component FROM part
WHERE (img, inst_id, component) IN (SELECT (img, inst_id, min(component)) FROM part GROUP BY img, inst_id)
GROUP BY img, inst_id, component""",
    ),
)
def mask_polygons(spark, sf):
    cells = cc.mask_polygons(_pred(spark, sf).select("img", "y", "x", "inst_id"), tile=32)
    return cells.withColumn("cell_x", r6(F.col("cell_x"))).withColumn("cell_y", r6(F.col("cell_y")))


_TOUR = _PARTS + """,
kept AS (
    SELECT img, inst_id, x::bigint AS x, y::bigint AS y FROM part
    WHERE (img, inst_id, component) IN (SELECT (img, inst_id, min(component)) FROM part GROUP BY img, inst_id)),
sides AS (
    SELECT img, inst_id, x AS x1, y AS y1, x + 1 AS x2, y AS y2, 0 AS way FROM kept
    UNION ALL SELECT img, inst_id, x + 1, y, x + 1, y + 1, 1 FROM kept
    UNION ALL SELECT img, inst_id, x + 1, y + 1, x, y + 1, 2 FROM kept
    UNION ALL SELECT img, inst_id, x, y + 1, x, y, 3 FROM kept),
line AS MATERIALIZED (
    SELECT * FROM sides s WHERE NOT EXISTS (
        SELECT 1 FROM sides t WHERE t.img = s.img AND t.inst_id = s.inst_id
            AND t.x1 = s.x2 AND t.y1 = s.y2 AND t.x2 = s.x1 AND t.y2 = s.y1)),
step AS MATERIALIZED (
    SELECT a.*, b.way AS onward FROM line a JOIN line b
      ON a.img = b.img AND a.inst_id = b.inst_id AND a.x2 = b.x1 AND a.y2 = b.y1
    QUALIFY row_number() OVER (
        PARTITION BY a.img, a.inst_id, a.x1, a.y1, a.way ORDER BY (b.way = (a.way + 1) % 4) DESC) = 1),
head AS (
    SELECT s.*, 0 AS pos, x1 AS hx, y1 AS hy FROM step s
    QUALIFY row_number() OVER (PARTITION BY img, inst_id ORDER BY y1, x1) = 1),
tour AS (
    SELECT * FROM head
    UNION ALL
    SELECT s.*, t.pos + 1, t.hx, t.hy FROM tour t JOIN step s
      ON s.img = t.img AND s.inst_id = t.inst_id AND s.x1 = t.x2 AND s.y1 = t.y2 AND s.way = t.onward
    WHERE t.x2 <> t.hx OR t.y2 <> t.hy)"""


@query(
    "mask_rings",
    d.sql(
        "masks",
        extra=_TOUR,
        body="""SELECT img, inst_id::bigint AS cell_ids,
    'POLYGON ((' || any_value(hx) || ' ' || any_value(hy)
    || string_agg(', ' || x2 || ' ' || y2, '' ORDER BY pos) FILTER (WHERE way <> onward) || '))' AS polygon
FROM tour GROUP BY img, inst_id""",
    ),
)
def mask_rings(spark, sf):
    """Outlines, one side after the other, of the first part of every predicted instance."""
    return cc.mask_rings(_pred(spark, sf).select("img", "y", "x", "inst_id"), tile=32)


@query(
    "export_instance_documents",
    d.sql(
        "masks",
        extra=_TOUR + """,
kinds AS (SELECT img, inst_id, CASE WHEN pixel_type = 5 THEN 0 ELSE pixel_type END AS t, y, x FROM px),
votes AS (
    SELECT img, inst_id, t, count(*) AS c,
        row_number() OVER (PARTITION BY img, inst_id ORDER BY (t = 0)::int, count(*) DESC, t) AS rn
    FROM kinds GROUP BY 1, 2, 3),
rings AS (
    SELECT img, inst_id, any_value(hx) || ' ' || any_value(hy) || string_agg(', ' || x2 || ' ' || y2, '' ORDER BY pos)
        FILTER (WHERE way <> onward AND (x2 <> hx OR y2 <> hy)) AS contour
    FROM tour GROUP BY 1, 2)""",
        body="""SELECT k.img, 40.0::double AS mag, k.inst_id::varchar AS id, min(y)::int AS rmin, min(x)::int AS cmin,
    (max(y) + 1)::int AS rmax, (max(x) + 1)::int AS cmax, round(avg(x), 6) AS centroid_x, round(avg(y), 6) AS centroid_y,
    any_value(v.t)::int AS type, round(any_value(v.c) / (count(*) + 1e-6), 6) AS type_prob, any_value(r.contour) AS contour
FROM kinds k JOIN votes v ON v.img = k.img AND v.inst_id = k.inst_id AND rn = 1
JOIN rings r ON r.img = k.img AND r.inst_id = k.inst_id GROUP BY k.img, k.inst_id""",
    ),
)
def export_instance_documents(spark, sf):
    """Whole documents with outlines, as text, read back through the declared schema."""
    kind = F.when(F.col("pixel_type") == 5, 0).otherwise(F.col("pixel_type"))
    px = _pred(spark, sf).withColumn("pixel_type", kind)
    corners = cc.outline_corners(px.select("img", "y", "x", "inst_id"), tile=32)
    texts = writers.instance_documents(mk.instance_info(px), corners, 40.0, per_line=16)
    read = texts.select("img", F.from_json("value", schemas.NUCLEI).alias("j"))
    n = read.select("img", "j.mag", F.explode("j.nuc").alias("id", "n"))
    points = F.transform("n.contour", lambda p: F.concat_ws(" ", p.cast("array<string>")))
    return n.select(
        "img", "mag", "id",
        *[F.col("n.bbox")[i][j].alias(c) for i, j, c in ((0, 0, "rmin"), (0, 1, "cmin"), (1, 0, "rmax"), (1, 1, "cmax"))],
        *[r6(F.col("n.centroid")[i]).alias(f"centroid_{c}") for i, c in enumerate("xy")],
        F.col("n.type").alias("type"), r6(F.col("n.type_prob")).alias("type_prob"), F.concat_ws(", ", points).alias("contour"),
    )


@query(
    "mask_hull_features",
    d.sql(
        "masks",
        extra=_PRED + """,
box AS (SELECT img, inst_id, min(y) AS y0, max(y) AS y1, min(x) AS x0, max(x) AS x1, count(*) AS area FROM px GROUP BY 1, 2),
bg AS (
    SELECT img, inst_id, y, x FROM (
        SELECT img, inst_id, unnest(range(y0, y1 + 1)) AS y, x0, x1 FROM box) b, LATERAL (
        SELECT unnest(range(b.x0, b.x1 + 1)) AS x)
    EXCEPT SELECT img, inst_id, y, x FROM px),
out AS (
    SELECT bg.* FROM bg JOIN box USING (img, inst_id) WHERE y IN (y0, y1) OR x IN (x0, x1)
    UNION
    SELECT b.* FROM out o JOIN bg b ON b.img = o.img AND b.inst_id = o.inst_id
        AND abs(b.y - o.y) + abs(b.x - o.x) = 1)""",
        body="""SELECT box.img, box.inst_id, area, (area + coalesce(h, 0))::bigint AS area_filled
FROM box LEFT JOIN (SELECT img, inst_id, count(*) AS h FROM (SELECT * FROM bg EXCEPT SELECT * FROM out) GROUP BY 1, 2) u
ON u.img = box.img AND u.inst_id = box.inst_id""",
    ),
)
def mask_hull_features(spark, sf):
    """Areas with the holes filled (convex areas are checked on fixtures)."""
    shapes = cc.hull_features(_pred(spark, sf).select("img", "y", "x", "inst_id"), tile=32)
    return shapes.select("img", "inst_id", "area", "area_filled")


@query(
    "mask_convex_areas",
    d.sql(
        "masks",
        extra=_PRED + """,
ends AS (
    SELECT img, inst_id, y::double AS y, min(x)::double AS lo, max(x)::double AS hi FROM px GROUP BY 1, 2, 3),
middles AS (
    SELECT img, inst_id, y, lo - 0.5::double AS l, hi + 0.5::double AS r FROM ends
    UNION ALL SELECT img, inst_id, y - 0.5::double, lo, hi FROM ends
    UNION ALL SELECT img, inst_id, y + 0.5::double, lo, hi FROM ends),
box AS (SELECT img, inst_id, min(y) AS y0, max(y) AS y1, count(*) AS area FROM px GROUP BY 1, 2),
scan AS (SELECT img, inst_id, area, unnest(range(y0, y1 + 1))::double AS y FROM box),
wide AS (
    SELECT s.img, s.inst_id, s.area, s.y,
        min(a.l + (b.l - a.l) * CASE WHEN b.y > a.y THEN (s.y - a.y) / (b.y - a.y) ELSE 0 END) AS low,
        max(a.r + (b.r - a.r) * CASE WHEN b.y > a.y THEN (s.y - a.y) / (b.y - a.y) ELSE 0 END) AS high
    FROM scan s
    JOIN middles a ON a.img = s.img AND a.inst_id = s.inst_id AND a.y <= s.y
    JOIN middles b ON b.img = s.img AND b.inst_id = s.inst_id AND b.y >= s.y
    GROUP BY 1, 2, 3, 4)""",
        body="""SELECT img, inst_id, c AS area_convex, area / c::double AS solidity FROM (
    SELECT img, inst_id, any_value(area) AS area,
        sum(floor(high + 1e-9::double) - ceil(low - 1e-9::double) + 1)::bigint AS c
    FROM wide GROUP BY img, inst_id)""",
    ),
)
def mask_convex_areas(spark, sf):
    """The text takes the widest chord over all pairs of points above and below a row."""
    shapes = cc.hull_features(_pred(spark, sf).select("img", "y", "x", "inst_id"), tile=32)
    return shapes.select("img", "inst_id", "area_convex", "solidity")


@query(
    "mask_split_parts",
    d.sql(
        "masks",
        extra="""px AS (SELECT img, y, x, pred_id AS inst_id FROM masks WHERE pred_id > 0 AND intensity > 120000),
seeds AS (SELECT img, y, x, inst_id, y * 64 + x AS k FROM px),
walk AS (
    SELECT img, inst_id, y, x, k FROM seeds
    UNION
    SELECT p.img, p.inst_id, p.y, p.x, w.k FROM walk w JOIN px p ON p.img = w.img AND p.inst_id = w.inst_id
        AND abs(p.y - w.y) <= 1 AND abs(p.x - w.x) <= 1),
part AS (SELECT img, inst_id, y, x, min(k) AS k FROM walk GROUP BY 1, 2, 3, 4),
heads AS (SELECT DISTINCT img, inst_id, k, min(k) OVER (PARTITION BY img, inst_id) AS k0 FROM part),
tops AS (SELECT img, max(inst_id) AS top FROM px GROUP BY 1),
fresh AS (
    SELECT img, inst_id, k, top + row_number() OVER (PARTITION BY img ORDER BY inst_id, k) AS id
    FROM heads JOIN tops USING (img) WHERE k <> k0)""",
        body="""SELECT p.img, p.y, p.x, coalesce(f.id, p.inst_id)::bigint AS inst_id FROM part p
LEFT JOIN fresh f ON f.img = p.img AND f.inst_id = p.inst_id AND f.k = p.k""",
    ),
)
def mask_split_parts(spark, sf):
    bright = _pred(spark, sf).filter("intensity > 120000").select("img", "y", "x", "inst_id")
    return cc.split_instances(bright, tile=16)


@query(
    "tile_patch_grid",
    d.sql(
        "masks",
        body="""SELECT img, (y0 / 16)::int AS "row", (x0 / 16)::int AS col, y0::int AS y0, (y0 + 32)::int AS y1,
    x0::int AS x0, (x0 + 32)::int AS x1
FROM (SELECT DISTINCT img FROM masks), range(0, 33, 16) a(y0), range(0, 33, 16) b(x0)""",
    ),
)
def tile_patch_grid(spark, sf):
    return tl.patch_grid(_images(spark, sf), 32, 16)


@query(
    "tile_output_windows",
    d.sql(
        "masks",
        body="""SELECT img, oy::int AS out_y, ox::int AS out_x, (oy - 5)::int AS in_y, (ox - 5)::int AS in_x
FROM (SELECT DISTINCT img FROM masks), range(5, 65, 20) a(oy), range(5, 65, 20) b(ox)""",
    ),
)
def tile_output_windows(spark, sf):
    return tl.output_windows(_images(spark, sf), 30, 20)


@query(
    "tile_processing_tiles",
    d.sql(
        "masks",
        body="""SELECT img, phase, y0::int AS y0, y1::int AS y1, x0::int AS x0, x1::int AS x1
FROM (SELECT DISTINCT img FROM masks), (
    SELECT 0 AS phase, y AS y0, least(y + 24, 64) AS y1, x AS x0, least(x + 24, 64) AS x1
    FROM range(0, 72, 24) a(y), range(0, 72, 24) b(x)
    UNION ALL SELECT 1, y, y + 24, x - 4, x + 4 FROM range(0, 72, 24) a(y), range(24, 72, 24) b(x)
    UNION ALL SELECT 2, y - 4, y + 4, x, x + 24 FROM range(24, 72, 24) a(y), range(0, 72, 24) b(x)
    UNION ALL SELECT 3, y - 8, y + 8, x - 8, x + 8 FROM range(24, 72, 24) a(y), range(24, 72, 24) b(x))""",
    ),
)
def tile_processing_tiles(spark, sf):
    return tl.processing_tiles(_images(spark, sf), 24, 4)


@query(
    "tile_valid",
    d.sql(
        "masks",
        body="""SELECT DISTINCT img, r::int AS "row", c::int AS col
FROM masks, range(0, 3) a(r), range(0, 3) b(c)
WHERE intensity > 498000 AND y >= r * 16 AND y < r * 16 + 32 AND x >= c * 16 AND x < c * 16 + 32""",
    ),
)
def tile_valid(spark, sf):
    """Patches that hold at least one very bright pixel."""
    grid = tl.patch_grid(_images(spark, sf), 32, 16)
    mask = d.masks(spark, sf).filter("intensity > 498000")
    return tl.valid_tiles(grid, mask, 32, 16).select("img", "row", "col")


@query(
    "tile_chunk_patches",
    d.sql(
        "masks",
        body="""SELECT img, k::int AS chunk, r::int AS "row", c::int AS col
FROM (SELECT DISTINCT img FROM masks), range(0, 3) a(r), range(0, 3) b(c), range(0, 2) t(k)
WHERE r * 16 >= k * 16 AND r * 16 + 32 <= k * 16 + 48 AND c * 16 + 32 <= 64""",
    ),
)
def tile_chunk_patches(spark, sf):
    images = _images(spark, sf)
    chunks = images.withColumn("chunk", F.explode(F.array(F.lit(0), F.lit(1)))).select(
        "img", "chunk", (F.col("chunk") * 16).alias("cy0"), (F.col("chunk") * 16 + 48).alias("cy1"),
        F.lit(0).alias("cx0"), F.lit(64).alias("cx1"),
    )
    listed = tl.chunk_patches(chunks, tl.patch_grid(images, 32, 16), 32, 16)
    return listed.select("img", "chunk", "row", "col")


_PATCHES = """pt AS (
    SELECT img, r AS "row", c AS col, y - r * 16 AS dy, x - c * 16 AS dx, pred_id AS inst_id
    FROM masks, range(0, 3) a(r), range(0, 3) b(c)
    WHERE pred_id > 0 AND y >= r * 16 AND y < r * 16 + 32 AND x >= c * 16 AND x < c * 16 + 32),
uniq AS (
    SELECT *, dense_rank() OVER (PARTITION BY img ORDER BY "row", col, inst_id) AS uid FROM pt)"""


def _patches(spark, sf):
    px = _pred(spark, sf).select("img", "y", "x", "inst_id")
    tiled = tl.pixel_tiles(px, 32, 16).filter("row < 3 and col < 3")
    return tiled.select(
        "img", "row", "col",
        (F.col("y") - F.col("row") * 16).alias("dy"), (F.col("x") - F.col("col") * 16).alias("dx"), "inst_id",
    )


@query(
    "tile_unique_ids",
    d.sql(
        "masks", extra=_PATCHES,
        body="""SELECT img, "row"::int AS "row", col::int AS col, dy::int AS dy, dx::int AS dx, uid::int AS inst_id FROM uniq""",
    ),
)
def tile_unique_ids(spark, sf):
    return tl.unique_ids(_patches(spark, sf))


_STITCHED = """,
sz AS (SELECT img, uid, count(*) AS size FROM uniq GROUP BY 1, 2 HAVING count(*) >= 4),
pos AS (
    SELECT u.img, u.uid, size, u.row, u.col, u.col % 2 AS layer, u.row * 16 + dy AS y, u.col * 16 + dx AS x
    FROM uniq u JOIN sz ON sz.img = u.img AND sz.uid = u.uid),
cover AS (
    SELECT y, x, layer, max(r) AS lr, max(c) AS lc
    FROM range(0, 64) a(y), range(0, 64) b(x), range(0, 2) l(layer), range(0, 3) p(r), range(0, 3) q(c)
    WHERE y >= r * 16 AND y < r * 16 + 32 AND x >= c * 16 AND x < c * 16 + 32 AND c % 2 = layer
    GROUP BY 1, 2, 3),
seen AS (SELECT pos.* FROM pos JOIN cover USING (y, x, layer) WHERE pos.row = lr AND pos.col = lc),
ranked AS (SELECT *, row_number() OVER (PARTITION BY img, y, x ORDER BY size DESC, layer) AS rn FROM seen)"""


@query(
    "tile_stitched",
    d.sql(
        "masks",
        extra=_PATCHES + _STITCHED,
        body="""SELECT img, y::int AS y, x::int AS x, uid::int AS inst_id FROM seen
WHERE (img, uid) NOT IN (SELECT (img, uid) FROM ranked WHERE rn > 1)""",
    ),
)
def tile_stitched(spark, sf):
    return tl.stitch(_patches(spark, sf), 3, 3, 32, 16)


@query(
    "tile_seam_repair",
    d.sql(
        "masks",
        extra="""old AS (SELECT img, y, x, pred_id AS inst_id FROM masks WHERE pred_id > 0),
t(tile, y0, y1, x0, x1) AS (VALUES (0, 0, 24, 0, 64), (1, 24, 64, 0, 64)),
st AS (
    SELECT img, tile, inst_id, bool_or(y = y0 OR y = y1 - 1 OR x = x0 OR x = x1 - 1) AS edge
    FROM old JOIN t ON y >= y0 AND y < y1 AND x >= x0 AND x < x1 GROUP BY 1, 2, 3),
kept AS (SELECT * FROM old WHERE (img, inst_id) NOT IN (SELECT (img, inst_id) FROM st WHERE NOT edge)),
fresh AS (
    SELECT img, tile, y, x, true_id AS inst_id FROM masks JOIN t ON y >= y0 AND y < y1 AND x >= x0 AND x < x1
    WHERE true_id > 0),
bad AS (SELECT DISTINCT f.img, f.tile, f.inst_id FROM fresh f JOIN kept k ON k.img = f.img AND k.y = f.y AND k.x = f.x),
ok AS (SELECT * FROM fresh WHERE (img, tile, inst_id) NOT IN (SELECT (img, tile, inst_id) FROM bad)),
tops AS (SELECT img, max(inst_id) AS top FROM old GROUP BY 1)""",
        body="""SELECT img, y, x, inst_id FROM kept UNION ALL
SELECT img, y, x, (top + dense_rank() OVER (PARTITION BY img ORDER BY tile, inst_id))::int AS inst_id
FROM ok JOIN tops USING (img)""",
    ),
)
def tile_seam_repair(spark, sf):
    m = d.masks(spark, sf)
    old = mk.foreground(m, "pred_id").select("img", "y", "x", "inst_id")
    cut = F.array(*[
        F.struct(F.lit(i).alias("tile"), F.lit(a).alias("y0"), F.lit(b).alias("y1"))
        for i, (a, b) in enumerate([(0, 24), (24, 64)])
    ])
    tiles = _images(spark, sf).withColumn("_t", F.explode(cut)).select(
        "img", "_t.*", F.lit(0).alias("x0"), F.lit(64).alias("x1")
    )
    fresh = mk.foreground(m, "true_id").select(
        "img", F.when(F.col("y") < 24, 0).otherwise(1).alias("tile"), "y", "x", "inst_id"
    )
    return tl.replace_in_tiles(old, fresh, tiles)


def _phase_sql(phase: int) -> str:
    """One repair phase over the mask of the phase before."""
    return f"""
st{phase} AS MATERIALIZED (
    SELECT m.img, inst_id, bool_or(y = y0 OR y = y1 - 1 OR x = x0 OR x = x1 - 1) AS edge
    FROM m{phase - 1} m JOIN t ON phase = {phase} AND y >= y0 AND y < y1 AND x >= x0 AND x < x1 GROUP BY m.img, tile, inst_id),
kept{phase} AS MATERIALIZED (
    SELECT * FROM m{phase - 1} m WHERE NOT EXISTS (
        SELECT 1 FROM st{phase} s WHERE s.img = m.img AND s.inst_id = m.inst_id AND NOT edge)),
bad{phase} AS MATERIALIZED (
    SELECT DISTINCT f.img, f.tile, f.inst_id FROM fresh f JOIN kept{phase} k USING (img, y, x) WHERE phase = {phase}),
m{phase} AS MATERIALIZED (
    SELECT img, y, x, inst_id FROM kept{phase} UNION ALL
    SELECT img, y, x, (top + dense_rank() OVER (PARTITION BY img ORDER BY tile, inst_id))::int AS inst_id
    FROM fresh f JOIN (SELECT img, max(inst_id) AS top FROM m{phase - 1} GROUP BY 1) USING (img)
    WHERE phase = {phase} AND NOT EXISTS (
        SELECT 1 FROM bad{phase} b WHERE b.img = f.img AND b.tile = f.tile AND b.inst_id = f.inst_id))"""


@query(
    "tile_three_phases",
    d.sql(
        "masks",
        extra="""cuts AS (
    SELECT phase, y - dy AS y0, x - dx AS x0, y + ey AS y1, x + ex AS x1, ys, xs
    FROM (VALUES (0, 0, 0, 32, 32, 0, 0), (1, 0, 8, 32, 8, 0, 1), (2, 8, 0, 8, 32, 1, 0), (3, 16, 16, 16, 16, 1, 1))
        p(phase, dy, dx, ey, ex, ys, xs), (VALUES (0), (32), (64)) a(y), (VALUES (0), (32), (64)) b(x)
    WHERE (ys = 0 OR y > 0) AND (xs = 0 OR x > 0)),
t AS (SELECT phase, y0 * 1000 + x0 AS tile, y0, x0, CASE phase WHEN 0 THEN least(y1, 64) ELSE y1 END AS y1,
             CASE phase WHEN 0 THEN least(x1, 64) ELSE x1 END AS x1 FROM cuts),
fresh AS MATERIALIZED (
    SELECT img, phase, tile, y, x, CASE phase WHEN 0 THEN pred_id ELSE true_id END AS inst_id
    FROM masks JOIN t ON y >= y0 AND y < y1 AND x >= x0 AND x < x1
    WHERE CASE phase WHEN 0 THEN pred_id ELSE true_id END > 0),
m0 AS MATERIALIZED (
    SELECT img, y, x, (dense_rank() OVER (PARTITION BY img ORDER BY tile, inst_id))::int AS inst_id
    FROM fresh WHERE phase = 0),"""
        + ",".join(_phase_sql(phase) for phase in (1, 2, 3)),
        body="SELECT img, y, x, inst_id FROM m3",
    ),
)
def tile_three_phases(spark, sf):
    """Instances of grid tiles, mended over the seams and then over their crossings."""
    tiles = tl.processing_tiles(_images(spark, sf), 32, 8).withColumn("tile", F.col("y0") * 1000 + F.col("x0"))
    covers = F.col("y").between(F.col("y0"), F.col("y1") - 1) & F.col("x").between(F.col("x0"), F.col("x1") - 1)
    found = F.when(F.col("phase") == 0, F.col("pred_id")).otherwise(F.col("true_id"))
    fresh = d.masks(spark, sf).join(tiles, "img").filter(covers).withColumn("inst_id", found).filter("inst_id > 0")
    return tl.merge_phases(fresh.select("img", "phase", "tile", "y", "x", "inst_id"), tiles)


@query(
    "tile_stitched_relabelled",
    d.sql(
        "masks",
        extra=_PATCHES + _STITCHED + """,
px AS MATERIALIZED (SELECT img, y, x, uid FROM seen WHERE (img, uid) NOT IN (SELECT (img, uid) FROM ranked WHERE rn > 1)),
walk AS (
    SELECT img, uid, y, x, y * 64 + x AS k FROM px
    UNION
    SELECT p.img, p.uid, p.y, p.x, w.k FROM walk w JOIN px p ON p.img = w.img AND p.uid = w.uid
        AND abs(p.y - w.y) <= 1 AND abs(p.x - w.x) <= 1),
part AS (SELECT img, y, x, min(k) AS k FROM walk GROUP BY 1, 2, 3)""",
        body="""SELECT img, y::int AS y, x::int AS x, (dense_rank() OVER (PARTITION BY img ORDER BY k))::int AS inst_id FROM part""",
    ),
)
def tile_stitched_relabelled(spark, sf):
    """The stitched mask with the ids of its connected parts."""
    return cc.relabel(tl.stitch(_patches(spark, sf), 3, 3, 32, 16), tile=16)


@query(
    "tile_reassembled",
    d.sql(
        "masks",
        body="SELECT img, y, x, pixel_type AS value FROM masks WHERE y < 50 AND x < 60",
    ),
)
def tile_reassembled(spark, sf):
    parts = d.masks(spark, sf).select(
        "img", F.expr("y div 16").cast("int").alias("row"), F.expr("x div 16").cast("int").alias("col"),
        F.expr("y % 16").alias("dy"), F.expr("x % 16").alias("dx"), F.col("pixel_type").alias("value"),
    )
    return tl.reassemble(parts, 16, 50, 60)


_PAIRS = """ov AS (SELECT img, true_id, pred_id, count(*) AS inter FROM masks GROUP BY 1, 2, 3),
ta AS (SELECT img, true_id, sum(inter)::bigint AS t_area FROM ov GROUP BY 1, 2),
pa AS (SELECT img, pred_id, sum(inter)::bigint AS p_area FROM ov GROUP BY 1, 2),
pairs AS (
    SELECT img, true_id, pred_id, inter, t_area, p_area, inter / (t_area + p_area - inter)::double AS iou
    FROM ov JOIN ta USING (img, true_id) JOIN pa USING (img, pred_id) WHERE true_id > 0 AND pred_id > 0)"""

_AJI = """,
best AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY img, true_id
        ORDER BY inter / (t_area + p_area - inter + 1e-6) DESC, pred_id) AS rn FROM pairs) WHERE rn = 1),
aji AS (
    SELECT img, i / (u + coalesce(et, 0) + coalesce(ep, 0))::double AS aji FROM (
        SELECT img, sum(inter) AS i, sum(t_area + p_area - inter) AS u FROM best GROUP BY 1)
    LEFT JOIN (SELECT img, sum(t_area) AS et FROM ta WHERE true_id > 0
               AND (img, true_id) NOT IN (SELECT (img, true_id) FROM best) GROUP BY 1) USING (img)
    LEFT JOIN (SELECT img, sum(p_area) AS ep FROM pa WHERE pred_id > 0
               AND (img, pred_id) NOT IN (SELECT (img, pred_id) FROM best) GROUP BY 1) USING (img)),
pq AS (
    SELECT img, tp / (tp + 0.5 * (np - tp) + 0.5 * (nt - tp)) AS dq, s / (tp + 1e-6) AS sq FROM (
        SELECT img, count(*) FILTER (WHERE iou > 0.5)::double AS tp,
               coalesce(sum(iou) FILTER (WHERE iou > 0.5), 0) AS s FROM pairs GROUP BY 1)
    JOIN (SELECT img, count(*)::double AS nt FROM ta WHERE true_id > 0 GROUP BY 1) USING (img)
    JOIN (SELECT img, count(*)::double AS np FROM pa WHERE pred_id > 0 GROUP BY 1) USING (img))"""


def _pairs(spark, sf):
    return ev.overlaps(d.masks(spark, sf))


@query(
    "quality_overlaps",
    d.sql(
        "masks", extra=_PAIRS,
        body="SELECT img, true_id, pred_id, inter, t_area, p_area, round(iou, 6) AS iou FROM pairs",
    ),
)
def quality_overlaps(spark, sf):
    return _pairs(spark, sf).withColumn("iou", r6(F.col("iou")))


@query(
    "quality_dice",
    d.sql(
        "masks",
        body="""SELECT img, round(2 * count(*) FILTER (WHERE true_id > 0 AND pred_id > 0)
    / (count(*) FILTER (WHERE true_id > 0) + count(*) FILTER (WHERE pred_id > 0))::double, 6) AS dice
FROM masks GROUP BY 1""",
    ),
)
def quality_dice(spark, sf):
    return ev.binary_dice(d.masks(spark, sf)).withColumn("dice", r6(F.col("dice")))


@query(
    "quality_ensemble_dice",
    d.sql(
        "masks", extra=_PAIRS,
        body="SELECT img, round(2 * sum(inter) / sum(t_area + p_area)::double, 6) AS dice2 FROM pairs GROUP BY 1",
    ),
)
def quality_ensemble_dice(spark, sf):
    return ev.ensemble_dice(_pairs(spark, sf)).withColumn("dice2", r6(F.col("dice2")))


@query(
    "quality_jaccard",
    d.sql("masks", extra=_PAIRS + _AJI, body="SELECT img, round(aji, 6) AS aji FROM aji"),
)
def quality_jaccard(spark, sf):
    return ev.jaccard_index(d.masks(spark, sf), _pairs(spark, sf)).withColumn("aji", r6(F.col("aji")))


@query("quality_jaccard_plus")
def quality_jaccard_plus(spark, sf):
    return ev.jaccard_index_plus(d.masks(spark, sf), _pairs(spark, sf))


@query(
    "quality_panoptic",
    d.sql(
        "masks", extra=_PAIRS + _AJI,
        body="SELECT img, round(dq, 6) AS dq, round(sq, 6) AS sq, round(dq * sq, 6) AS pq FROM pq",
    ),
)
def quality_panoptic(spark, sf):
    scored = ev.panoptic_quality(d.masks(spark, sf), _pairs(spark, sf))
    return scored.select("img", *[r6(F.col(c)).alias(c) for c in ("dq", "sq", "pq")])


@query(
    "quality_mean_scores",
    d.sql(
        "masks", extra=_PAIRS + _AJI,
        body="""SELECT round(avg(aji), 6) AS aji, round(avg(dq), 6) AS dq, round(avg(sq), 6) AS sq,
    round(avg(dq * sq), 6) AS pq FROM aji FULL JOIN pq USING (img)""",
    ),
)
def quality_mean_scores(spark, sf):
    masks, pairs = d.masks(spark, sf), _pairs(spark, sf)
    means = ev.mean_scores(ev.jaccard_index(masks, pairs), ev.panoptic_quality(masks, pairs))
    return means.select(*[r6(F.col(c)).alias(c) for c in means.columns])


def _centroids(spark, sf, column):
    px = mk.foreground(d.masks(spark, sf), column)
    info = mk.instance_info(px)
    return info.select(
        "img", "inst_id", F.col("centroid_x").alias("cx"), F.col("centroid_y").alias("cy"), "type"
    )


@query("quality_point_matches")
def quality_point_matches(spark, sf):
    return ev.match_points(_centroids(spark, sf, "true_id"), _centroids(spark, sf, "pred_id"))


@query("quality_type_statistics")
def quality_type_statistics(spark, sf):
    true, pred = _centroids(spark, sf, "true_id"), _centroids(spark, sf, "pred_id")
    return ev.type_statistics(true, pred, ev.match_points(true, pred), [1, 2, 3, 4, 5])


_VALID = """v AS (
    SELECT img, intensity / 500000 AS prob, (true_id > 0)::int AS t, pixel_type AS tt,
           (CASE WHEN pred_id = true_id THEN pixel_type ELSE 1 END) AS pt FROM masks)"""


def _predictions(spark, sf):
    return d.masks(spark, sf).select(
        "img",
        (F.col("intensity") / 500000).alias("prob"),
        (F.col("true_id") > 0).cast("int").alias("true"),
        F.col("pixel_type").alias("true_type"),
        F.when(F.col("pred_id") == F.col("true_id"), F.col("pixel_type")).otherwise(1).alias("pred_type"),
        F.lit(0.0).alias("true_h"), F.lit(0.0).alias("true_v"),
        (F.col("intensity") / 500000).alias("pred_h"), F.lit(0.0).alias("pred_v"),
    )


@query(
    "quality_validation",
    d.sql(
        "masks", extra=_VALID,
        body="""SELECT round(avg(((prob > 0.5)::int = t)::int), 6) AS np_acc,
    round(2 * count(*) FILTER (WHERE prob > 0.5 AND t = 1)
        / (count(*) FILTER (WHERE prob > 0.5) + count(*) FILTER (WHERE t = 1) + 1e-8), 6) AS np_dice, """
        + ", ".join(
            f"round(2 * count(*) FILTER (WHERE tt = {k} AND pt = {k}) / (count(*) FILTER (WHERE tt = {k})"
            f" + count(*) FILTER (WHERE pt = {k}) + 1e-8), 6) AS tp_dice_{k}"
            for k in (1, 2, 3)
        )
        + ", round(sum(prob * prob) / count(*), 6) AS hv_mse FROM v",
    ),
)
def quality_validation(spark, sf):
    scalars = ev.validation_scalars(_predictions(spark, sf), [1, 2, 3])
    return scalars.select(*[r6(F.col(c)).alias(c) for c in scalars.columns])


@query(
    "quality_confusion",
    d.sql(
        "masks", extra=_VALID,
        body='SELECT tt AS "True", pt AS "Pred", count(*) AS value FROM v GROUP BY 1, 2',
    ),
)
def quality_confusion(spark, sf):
    return ev.confusion(_predictions(spark, sf), "true_type", "pred_type")


@query(
    "quality_losses",
    d.sql(
        "masks", extra=_VALID,
        body="""SELECT img, round(1 - (2 * sum(prob * t) + 1e-3) / (sum(prob) + sum(t) + 1e-3), 6) AS dice_loss,
    round(avg((prob - t) ** 2), 6) AS mse_loss,
    round(avg(-(t * ln(greatest(least(prob, 1 - 1e-7), 1e-7)) + (1 - t) * ln(1 - greatest(least(prob, 1 - 1e-7), 1e-7)))), 6)
        AS bce_loss
FROM v GROUP BY 1""",
    ),
)
def quality_losses(spark, sf):
    losses = ev.loss_terms(_predictions(spark, sf), "img", "prob", "true")
    return losses.select("img", *[r6(F.col(c)).alias(c) for c in ("dice_loss", "mse_loss", "bce_loss")])


@query(
    "quality_class_merge",
    d.sql(
        "masks",
        body="""SELECT CASE WHEN pixel_type IN (3, 4) THEN 3 WHEN pixel_type IN (5, 6, 7) THEN 4 ELSE pixel_type END::int AS type,
    count(*) AS pixels FROM masks GROUP BY 1""",
    ),
)
def quality_class_merge(spark, sf):
    t = F.col("pixel_type")
    merged = F.when(t.isin(3, 4), 3).when(t.isin(5, 6, 7), 4).otherwise(t)
    return d.masks(spark, sf).groupBy(merged.alias("type")).agg(F.count("*").alias("pixels"))


@query(
    "history_moving_average",
    d.sql(
        extra="",
        body="""WITH o AS (
    SELECT user_id, event_id, value, row_number() OVER w AS n, count(*) OVER (PARTITION BY user_id) AS c
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
p AS (SELECT a.user_id, a.event_id, sum(CASE WHEN b.n = 1 THEN power(0.95, a.n - 1) * b.value
        ELSE 0.05 * power(0.95, a.n - b.n) * b.value END) AS ema
      FROM o a JOIN o b ON b.user_id = a.user_id AND b.n <= a.n GROUP BY 1, 2)
SELECT user_id, event_id, round(ema + 1e-9, 6) AS ema FROM p""",
    ),
)
def history_moving_average(spark, sf):
    events = d.table(spark, sf, "events")
    averaged = h.moving_average(events, "user_id", "event_id", "value")
    # Early averages have few decimals; the shift keeps exact halves on one side.
    return averaged.withColumn("ema", r6(F.col("ema") + 1e-9))


@query(
    "history_best_so_far",
    """SELECT user_id, event_id, value,
    value > coalesce(max(value) OVER (PARTITION BY user_id ORDER BY event_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '-inf'::double) AS is_best FROM events""",
)
def history_best_so_far(spark, sf):
    return h.best_so_far(d.table(spark, sf, "events"), "user_id", "event_id", "value")


@query(
    "history_epoch_means",
    """SELECT user_id AS epoch, event_type AS metric, count(*) AS batches, round(avg(value), 6) AS mean
FROM events GROUP BY 1, 2""",
)
def history_epoch_means(spark, sf):
    raw = d.table(spark, sf, "events").select(
        F.col("user_id").alias("epoch"), F.col("event_type").alias("metric"), "value"
    )
    return h.epoch_means(raw, "epoch", "metric", "value").withColumn("mean", r6(F.col("mean")))
