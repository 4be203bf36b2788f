"""Spatial joins on a grid, region membership and infiltration levels.

Spark has no index for geometry. Every spatial join here is an equi-join on grid
buckets followed by an exact predicate, so it shuffles by bucket and never pairs
a whole side with a whole side. Boxes are filed at the grid level that matches
their size, which bounds the number of buckets per box by four.

Coordinates belong to one slide. With several slides in a table, ``by`` names the
columns that tell them apart; they are part of every join key and group. Rows in
which one of them is NULL belong to no slide and meet nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions import geometry as geo
from ..functions.numeric import ratio, value_bucket
from ..functions.probability import normal_tail, normal_two_sided
from .merge import NOT_DECONVOLVED

# Rows of a hot bucket are spread over this many partitions; boxes are few.
SALT = 8


def _bucket(value: Column, size: Column) -> Column:
    return F.floor(value / size)


BOX = ("_x0", "_y0", "_x1", "_y1")


def box_join(
    points: DataFrame,
    boxes: DataFrame,
    x: str,
    y: str,
    unit: float,
    how: str = "inner",
    salt: int = SALT,
    by: Sequence[str] = (),
) -> DataFrame:
    """Pairs of points and boxes that contain them (bounds inclusive).

    ``boxes`` carries its bounds in the columns of ``BOX``. With ``how='left'`` a
    point without a box in its bucket comes back with NULLs, once per box size.
    """
    extent = F.greatest(
        F.col("_x1") - F.col("_x0"), F.col("_y1") - F.col("_y0"), F.lit(float(unit))
    )
    sized = boxes.withColumn("_level", F.ceil(F.log2(extent / unit) - 1e-12).cast("int"))
    levels = sized.agg(F.collect_set("_level")).scalar()
    size = F.pow(F.lit(2.0), F.col("_level")) * unit

    def span(low: str, high: str) -> Column:
        return F.explode(F.sequence(_bucket(F.col(low), size), _bucket(F.col(high), size)))

    filed = (
        sized.withColumn("_bx", span("_x0", "_x1"))
        .withColumn("_by", span("_y0", "_y1"))
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    )
    explode = F.explode_outer if how == "left" else F.explode
    probing = (
        points.withColumn("_level", explode(levels))
        .withColumn("_bx", _bucket(F.col(x), size))
        .withColumn("_by", _bucket(F.col(y), size))
        .withColumn("_salt", F.pmod(F.xxhash64(x, y), F.lit(salt)).cast("int"))
    )
    keys = ["_level", "_bx", "_by", "_salt"]
    joined = probing.join(filed, [*by, *keys], how).drop(*keys)
    hit = F.col(x).between(F.col("_x0"), F.col("_x1")) & F.col(y).between(
        F.col("_y0"), F.col("_y1")
    )
    if how == "left":
        return joined.withColumn("_hit", F.coalesce(hit, F.lit(False))).drop(*BOX)
    return joined.filter(hit).drop(*BOX)


def assign_cells_to_spots(
    cells: DataFrame, spots: DataFrame, radius: float, order: str = "barcode", by: Sequence[str] = ()
) -> DataFrame:
    """Every cell with the barcode of the spot that holds its centroid, or NULL.

    Where spots overlap the one with the largest ``order`` wins. Only the cells that
    lie in a spot are grouped; the others keep their place and get NULL.
    """
    cx = F.col("pxl_col_in_fullres").cast("double")
    cy = F.col("pxl_row_in_fullres").cast("double")
    centres = spots.select(
        *by,
        F.col("barcode").alias("_spot"),
        F.col(order).alias("_order"),
        cx.alias("_cx"),
        cy.alias("_cy"),
        (cx - radius).alias("_x0"),
        (cy - radius).alias("_y0"),
        (cx + radius).alias("_x1"),
        (cy + radius).alias("_y1"),
    )
    keys = [*by, "cell_ids"]
    places = cells.select(*keys, "cell_x", "cell_y")
    near = box_join(places, centres, "cell_x", "cell_y", 2 * radius, by=by)
    inside = geo.in_buffered_point(
        F.col("cell_x") - F.col("_cx"), F.col("cell_y") - F.col("_cy"), radius
    )
    hits = near.filter(inside).groupBy(*keys).agg(F.max_by("_spot", "_order").alias("barcode"))
    return cells.join(hits, keys, "left")


def contained_cells(cells: DataFrame, spots: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Spots with the number of their cells (zero included)."""
    keys = [*by, "barcode"]
    counts = (
        cells.filter(F.col("barcode").isNotNull())
        .groupBy(*keys)
        .agg(F.count("*").alias("num_contained_cells"))
    )
    return spots.join(counts, keys, "left").na.fill(0, ["num_contained_cells"])


def filter_by_area(
    cells: DataFrame,
    mode: str = "quantile",
    lower: float = 0.01,
    upper: float = 0.99,
    max_z: float = 3.0,
) -> DataFrame:
    """Drop outlying areas: strictly between two quantiles, or |z| below a limit."""
    area = F.col("area")
    if mode == "quantile":
        low = area_quantile(cells, lower)
        high = area_quantile(cells, upper)
        return cells.filter((area > low) & (area < high))
    mean = cells.agg(F.avg("area")).scalar()
    std = cells.agg(F.stddev_pop("area")).scalar()
    return cells.filter(F.abs(F.try_divide(area - mean, std)) < max_z)


def area_quantile(cells: DataFrame, q: float, column: str = "area") -> Column:
    """Exact linear-interpolated quantile of a column, as a scalar.

    ``percentile`` merges value histograms on one task, which is unbounded for
    continuous values. Here the bucket that holds the wanted rank is found from
    the bucket totals first and only that narrow value range is ranked.
    """
    values = cells.filter(F.col(column).isNotNull()).select(
        F.col(column).cast("double").alias("v"),
    ).withColumn("b", value_bucket(F.col("v"), 1024))
    totals = values.groupBy("b").agg(F.count("*").alias("c"))
    ordered = Window.orderBy("b")
    steps = totals.select(
        "b",
        F.sum("c").over(ordered).alias("upto"),
        (F.sum("c").over(ordered) - F.col("c")).alias("before"),
        F.sum("c").over(Window.partitionBy(F.lit(1))).alias("n"),
    ).withColumn("pos", F.lit(q) * (F.col("n") - 1))
    wanted = steps.filter(
        (F.col("before") <= F.ceil("pos")) & (F.col("upto") > F.floor("pos"))
    )
    histogram = values.join(wanted, "b").groupBy("v", "b", "before", "pos").agg(
        F.count("*").alias("c")
    )
    inner = Window.partitionBy("b").orderBy("v")
    ranked = histogram.withColumn("upto", F.col("before") + F.sum("c").over(inner))
    low = F.min(F.when(F.col("upto") > F.floor("pos"), F.col("v")))
    high = F.min(F.when(F.col("upto") > F.ceil("pos"), F.col("v")))
    part = F.any_value(F.col("pos") - F.floor("pos"))
    return ranked.agg(low + (high - low) * part).scalar()


def tissue_box(
    spots: DataFrame, patch: int, height: int | None = None, width: int | None = None
) -> DataFrame:
    """Bounds [y0, y1, x0, x1] of the tissue spots, widened by a patch and clamped."""
    kept = spots.filter(
        (F.col("in_tissue") == 1)
        & (F.col("pxl_row_in_fullres") >= 0)
        & (F.col("pxl_col_in_fullres") >= 0)
    )
    if height is not None:
        kept = kept.filter(F.col("pxl_row_in_fullres") < height)
    if width is not None:
        kept = kept.filter(F.col("pxl_col_in_fullres") < width)

    def low(c: str) -> Column:
        return F.greatest(F.min(c) - patch, F.lit(0))

    def high(c: str, limit: int | None) -> Column:
        top = F.max(c) + patch
        return top if limit is None else F.least(top, F.lit(limit))

    return kept.agg(
        low("pxl_row_in_fullres").alias("y0"),
        high("pxl_row_in_fullres", height).alias("y1"),
        low("pxl_col_in_fullres").alias("x0"),
        high("pxl_col_in_fullres", width).alias("x1"),
    )


def region_edges(regions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per edge: end points, unit direction, outward normal, corner at its end.

    ``turn`` is positive where that corner sticks out of the polygon. A ring may
    repeat its first point at the end.
    """
    keys = [*by, "region_class", "region_name"]
    corners = regions.select(*keys, F.posexplode(geo.open_ring(F.col("ring"))).alias("i", "_p"))
    ordered = Window.partitionBy(*keys).orderBy("i")
    whole = Window.partitionBy(*keys)

    def following(c: str) -> Column:
        return F.coalesce(F.lead(c).over(ordered), F.first(c).over(ordered))

    flat = corners.select(
        *keys, "i", F.col("_p.x").cast("double").alias("x1"), F.col("_p.y").cast("double").alias("y1")
    )
    edges = flat.select(
        "*", following("x1").alias("x2"), following("y1").alias("y2")
    ).filter("x1 != x2 or y1 != y2")
    length = F.sqrt(F.pow(F.col("x2") - F.col("x1"), 2) + F.pow(F.col("y2") - F.col("y1"), 2))
    twice_area = F.sum(F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")).over(whole)
    directed = edges.select(
        "*",
        length.alias("len"),
        ((F.col("x2") - F.col("x1")) / length).alias("ux"),
        ((F.col("y2") - F.col("y1")) / length).alias("uy"),
        F.when(twice_area >= 0, 1.0).otherwise(-1.0).alias("sign"),
    )
    turned = directed.select("*", following("ux").alias("vx"), following("uy").alias("vy"))
    sign = F.col("sign")
    return turned.select(
        "*",
        (sign * F.col("uy")).alias("nx"),
        (-sign * F.col("ux")).alias("ny"),
        (sign * (F.col("uy") + F.col("vy"))).alias("sx"),
        (-sign * (F.col("ux") + F.col("vx"))).alias("sy"),
        (sign * (F.col("ux") * F.col("vy") - F.col("uy") * F.col("vx"))).alias("turn"),
    )


WALL = ["i", "x1", "y1", "x2", "y2", "len", "ux", "uy", "nx", "ny", "vx", "vy", "sx", "sy", "turn"]


def with_edges(regions: DataFrame, reach: float = 0.0, by: Sequence[str] = ()) -> DataFrame:
    """(slide, region_class, region_name, edges, bounds widened by ``reach``).

    A group per polygon: its size is the number of corners someone drew.
    """
    return region_edges(regions, by).groupBy(*by, "region_class", "region_name").agg(
        F.sort_array(F.collect_list(F.struct(*WALL))).alias("edges"),
        (F.min("x1") - reach).alias("_x0"),
        (F.min("y1") - reach).alias("_y0"),
        (F.max("x1") + reach).alias("_x1"),
        (F.max("y1") + reach).alias("_y1"),
    )


def _over_edges(near: DataFrame, key: Sequence[str], *aggs: Column) -> DataFrame:
    """Fold the edges of every (point, region) pair.

    The edges are unfolded in place and folded back by a hash aggregation. That
    stays in generated code, and the map side already merges the edges of a pair,
    so only one row per pair is shuffled. Texts of a point are keys beside its own: an
    aggregate over texts would sort all edges of all pairs.
    """
    keys = ["region_class", "region_name", *key]
    rest = [c for c in near.columns if c not in [*keys, "edges"]]
    texts = [c for c in rest if isinstance(near.schema[c].dataType, StringType)]
    rows = near.select(*keys, *rest, F.explode("edges").alias("_e"))
    kept = [F.any_value(c).alias(c) for c in rest if c not in texts]
    return rows.groupBy(*keys, *texts).agg(*kept, *aggs)


def _inside_aggs(x: Column, y: Column) -> list[Column]:
    e = F.col("_e")
    return [
        F.count_if(geo.crosses(e, x, y)).alias("_crossings"),
        F.count_if(geo.touches(e, x, y)).alias("_touching"),
    ]


INSIDE = "_crossings % 2 = 1 and _touching = 0"


def region_rows(regions: DataFrame, by: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(boxes, rows): every polygon cut into rows of equal height, each with the edges that reach it.

    Whether a point lies inside depends on the edges at its height only, so a row answers
    for its points alone. There are as many rows as keep the edges, counted in every row
    they reach, below twice their number: a row has about as many as a level line crosses.
    A polygon is spread over its rows; ``_region`` names it in both tables.
    """
    keys = [*by, "region_class", "region_name"]
    named = region_edges(regions, by).withColumn("_region", F.struct(*keys))
    rise = F.abs(F.col("y2") - F.col("y1"))
    boxes = named.groupBy("_region").agg(
        F.min("x1").alias("_x0"), F.min("y1").alias("_y0"), F.max("x1").alias("_x1"), F.max("y1").alias("_y1"),
        F.count("*").alias("_n"), F.sum(rise).alias("_rise"),
    )
    height = F.col("_y1") - F.col("_y0")
    rows = F.greatest(F.floor(F.try_divide(F.col("_n") * height, F.col("_rise"))), F.lit(1))
    unit = F.when(height > 0, height / rows).otherwise(1.0)
    boxes = boxes.select("_region", *BOX, F.col("_y0").alias("_top"), unit.alias("_unit"))
    low, high = (row_of(f("y1", "y2"), F.col("_top"), F.col("_unit")) for f in (F.least, F.greatest))
    reached = named.join(boxes.select("_region", "_top", "_unit"), "_region").select(
        "_region", F.explode(F.sequence(low, high)).alias("_row"), F.struct("x1", "y1", "x2", "y2").alias("_e")
    )
    return boxes, reached.groupBy("_region", "_row").agg(F.collect_list("_e").alias("_edges"))


def row_of(y: Column, top: Column, unit: Column) -> Column:
    """Number of the row at a height; rounding keeps its order, so edges reach the rows of their points."""
    return F.floor((y - top) / unit)


def region_members(
    points: DataFrame,
    regions: DataFrame,
    key: str,
    x: str,
    y: str,
    unit: float = 256.0,
    by: Sequence[str] = (),
) -> DataFrame:
    """(region_class, region_name, point columns) of points strictly inside.

    A point meets the boxes of polygons first and then the one row of each at its height.
    """
    boxes, rows = region_rows(regions, by)
    boxes = boxes.select(*[F.col(f"_region.{c}").alias(c) for c in (*by, "region_class", "region_name")], "*")
    near = box_join(points, boxes, x, y, unit, by=by)
    placed = near.withColumn("_row", row_of(F.col(y).cast("double"), F.col("_top"), F.col("_unit")))
    inside = placed.join(rows, ["_region", "_row"]).filter(geo.contains(F.col("_edges"), F.col(x), F.col(y)))
    rest = [c for c in points.columns if c not in (*by, key)]
    return inside.select("region_class", "region_name", *by, key, *rest)


def members_of_sized_regions(
    spots: DataFrame, regions: DataFrame, min_spots: int = 2, by: Sequence[str] = ()
) -> DataFrame:
    """``region_members`` of spots, for regions that hold at least ``min_spots`` of them."""
    hits = region_members(
        spots, regions, "barcode", "pxl_col_in_fullres", "pxl_row_in_fullres", by=by
    )
    keys = [*by, "region_class", "region_name"]
    sized = hits.groupBy(*keys).agg(F.count("*").alias("_k")).filter(F.col("_k") >= min_spots)
    return hits.join(sized.drop("_k"), keys, "left_semi")


def region_sizes(
    cells: DataFrame,
    spots: DataFrame,
    regions: DataFrame,
    min_spots: int = 2,
    by: Sequence[str] = (),
) -> DataFrame:
    """Cells and spots per region; regions with fewer than two spots are dropped."""
    keys = [*by, "region_class", "region_name"]
    per_cell = (
        region_members(cells, regions, "cell_ids", "cell_x", "cell_y", by=by)
        .groupBy(*keys)
        .agg(F.count("*").alias("num_cells"))
    )
    per_spot = (
        region_members(spots, regions, "barcode", "pxl_col_in_fullres", "pxl_row_in_fullres", by=by)
        .groupBy(*keys)
        .agg(F.count("*").alias("num_spots"))
        .filter(F.col("num_spots") >= min_spots)
    )
    return per_spot.join(per_cell, keys, "left").na.fill(0, ["num_cells"])


def cluster_sizes(
    cells: DataFrame, spots: DataFrame, cluster: str = "cluster", by: Sequence[str] = ()
) -> DataFrame:
    """Cells and spots of every expression cluster."""
    keys = [*by, "barcode"]
    per_spot = cells.filter(F.col("barcode").isNotNull()).groupBy(*keys).agg(
        F.count("*").alias("_n")
    )
    return (
        spots.join(per_spot, keys, "left")
        .groupBy(*by, cluster)
        .agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("num_cells"),
            F.count("*").alias("num_spots"),
        )
    )


def infiltration_levels(
    cells: DataFrame,
    regions: DataFrame,
    step: int,
    levels: int = 4,
    join_style: str = "bevel",
    unit: float = 512.0,
    by: Sequence[str] = (),
) -> DataFrame:
    """Level of every cell near a region: the narrowest buffer that still holds it.

    Buffers lie ``step`` apart, from ``levels * step`` outside the region inwards
    until nothing is left. A point on a buffer's boundary is outside that buffer.
    """
    reach = float(levels * step)
    kept = cells.filter(F.col("cell_type") != NOT_DECONVOLVED)
    near = box_join(kept, with_edges(regions, reach, by), "cell_x", "cell_y", unit, by=by)
    x, y = F.col("cell_x"), F.col("cell_y")
    e = F.col("_e")
    if join_style == "bevel":
        outer, inner = geo.buffer_reach(e, x, y, 1.0), geo.buffer_reach(e, x, y, -1.0)
    else:
        outer = inner = geo.segment_gap(e, x, y)
    scanned = _over_edges(
        near, [*by, "cell_ids"], *_inside_aggs(x, y), F.min(outer).alias("_out"), F.min(inner).alias("_in")
    )
    distance = F.when(F.expr(INSIDE), -F.col("_in")).otherwise(F.col("_out"))
    placed = scanned.withColumn("_d", F.round(distance, 9)).filter(F.col("_d") < reach)
    return placed.withColumn(
        "infilt_level", ((F.floor(F.col("_d") / step) + 1) * step).cast("int")
    ).drop("_crossings", "_touching", "_out", "_in", "_d")


def infiltration_table(
    levels: DataFrame, spot_diameter: float, step: int, by: Sequence[str] = ()
) -> DataFrame:
    """Abundance and share of each type per region and level, with bounds in micron."""
    keys = [*by, "region_class", "region_name"]
    counts = levels.groupBy(*keys, "infilt_level", "cell_type").agg(F.count("*").alias("abundance"))
    types_of_level = Window.partitionBy(*keys, "infilt_level")
    counts = counts.withColumn("_t", F.sum("abundance").over(types_of_level))

    def micron(px: Column) -> Column:
        value = px * (65.0 / spot_diameter)
        return F.when(value >= 0, F.floor(value)).otherwise(F.ceil(value)).cast("int")

    upper, lower = micron(F.col("infilt_level")), micron(F.col("infilt_level") - step)
    return counts.select(
        *keys,
        F.col("infilt_level").alias("level"),
        "cell_type",
        "abundance",
        ratio(F.col("abundance"), F.col("_t")).alias("proportion"),
        upper.alias("upper_bound"),
        lower.alias("lower_bound"),
        ((upper + lower) / 2).alias("mid_point"),
    )


def infiltration_grid(levels: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Abundance for every level and every type of a region, zeros included.

    Levels and types of one region are few; they are listed and unfolded in place.
    """
    keys = [*by, "region_class", "region_name"]
    counts = levels.groupBy(*keys, "infilt_level", "cell_type").agg(
        F.count("*").alias("abundance")
    )
    folded = counts.groupBy(*keys).agg(
        F.collect_set("infilt_level").alias("_levels"),
        F.collect_set("cell_type").alias("_types"),
        F.map_from_entries(
            F.collect_list(
                F.struct(F.struct("infilt_level", "cell_type").alias("k"), F.col("abundance").alias("v"))
            )
        ).alias("_n"),
    )
    grid = folded.withColumn("infilt_level", F.explode("_levels")).withColumn(
        "cell_type", F.explode("_types")
    )
    found = F.try_element_at("_n", F.struct("infilt_level", "cell_type"))
    return grid.select(
        *keys,
        F.col("infilt_level").alias("level"),
        "cell_type",
        F.coalesce(found, F.lit(0)).alias("abundance"),
    )


def infiltration_test(
    table: DataFrame,
    buffer: bool = True,
    alternative: str = "two-sided",
    p_limit: float = 0.05,
    by: Sequence[str] = (),
) -> DataFrame:
    """Pooled two-proportion z of every type, inside against outside its region, with
    its p-value and whether that lies below ``p_limit``.

    ``alternative`` is ``two-sided``, ``larger`` (more of the type inside) or ``smaller``.

    With ``buffer`` the band up to the gap between the type's two outermost levels
    is left out on both sides of the boundary. Types seen at fewer than two levels
    and regions with an empty side give z = 0 and p = 1, without significance; z and p
    are NULL where a type makes up all or none of both sides. ``table`` is already counted, so a
    region has at most levels x types rows.
    """
    tail = {
        "two-sided": lambda z: normal_two_sided(z),
        "larger": lambda z: normal_tail(z),
        "smaller": lambda z: normal_tail(-z),
    }[alternative]
    keys = [*by, "region_class", "region_name"]
    mine = table.groupBy(*keys, "cell_type").agg(
        F.collect_list(F.struct("level", "abundance")).alias("_mine")
    )
    levels = F.sort_array(F.transform("_mine", lambda r: r["level"]), asc=False)
    gap = (F.get(levels, F.lit(0)) - F.get(levels, F.lit(1))) if buffer else F.lit(0)
    of_region = Window.partitionBy(*keys)
    rows = mine.select(
        *keys,
        "cell_type",
        "_mine",
        gap.alias("gap"),
        F.flatten(F.collect_list("_mine").over(of_region)).alias("_all"),
    )

    def total(array: str, within: bool) -> Column:
        def side(r: Column) -> Column:
            return r["level"] <= -F.col("gap") if within else r["level"] > F.col("gap")

        return F.aggregate(
            F.filter(array, side), F.lit(0.0), lambda acc, r: acc + r["abundance"]
        )

    sums = rows.select(
        *keys,
        "cell_type",
        "gap",
        total("_mine", True).alias("x1"),
        total("_mine", False).alias("x2"),
        total("_all", True).alias("n1"),
        total("_all", False).alias("n2"),
    )
    pooled = F.try_divide(F.col("x1") + F.col("x2"), F.col("n1") + F.col("n2"))
    inverse = F.try_divide(F.lit(1.0), F.col("n1")) + F.try_divide(F.lit(1.0), F.col("n2"))
    lead = F.try_divide(F.col("x1"), F.col("n1")) - F.try_divide(F.col("x2"), F.col("n2"))
    z = F.try_divide(lead, F.sqrt(pooled * (1 - pooled) * inverse))
    usable = (F.col("n1") > 0) & (F.col("n2") > 0)
    if buffer:
        usable = usable & F.col("gap").isNotNull()
    scored = sums.withColumn("z", F.when(usable, z).otherwise(F.lit(0.0)))
    p = F.when(F.col("z").isNotNull(), tail(F.coalesce("z", F.lit(0.0))))
    return scored.select(
        *keys, "cell_type", "x1", "x2", "n1", "n2", "z",
        F.when(usable, p).otherwise(F.lit(1.0)).alias("p"),
        F.when(usable, F.coalesce(p < p_limit, F.lit(False))).otherwise(F.lit(False)).alias("significant"),
    )
