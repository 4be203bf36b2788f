"""Label masks as pixel tables (img, y, x, inst_id); background pixels are absent."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import ratio
from ..functions.ordering import running_sum

KEYS = ["img", "inst_id"]


def foreground(pixels: DataFrame, column: str) -> DataFrame:
    return pixels.filter(F.col(column) > 0).withColumn("inst_id", F.col(column))


def instance_sizes(pixels: DataFrame) -> DataFrame:
    return pixels.groupBy(*KEYS).agg(F.count("*").alias("size"))


def drop_small(pixels: DataFrame, threshold: int = 8) -> DataFrame:
    """Pixels of instances with at least ``threshold`` pixels."""
    kept = instance_sizes(pixels).filter(F.col("size") >= threshold)
    return pixels.join(kept, KEYS, "left_semi")


def remove_instances(pixels: DataFrame, listed: DataFrame) -> DataFrame:
    return pixels.join(listed, KEYS, "left_anti")


def dense_ids(pixels: DataFrame, by_size: bool = False) -> DataFrame:
    """(img, inst_id, new_id): ids 1..n per image, in id order or largest first.

    Ranks come from running sums over ranges of ids (or sizes), so an image with
    very many instances is not ranked in one task.
    """
    sizes = instance_sizes(pixels)
    if by_size:
        order = [F.desc("size"), F.asc("inst_id")]
        bucket = -F.floor(F.log2("size") * 16)
    else:
        order = [F.asc("inst_id")]
        bucket = F.floor(F.col("inst_id") / 4096)
    ranked = running_sum(sizes, ["img"], bucket.cast("long"), order, F.lit(1), "new_id")
    return ranked.select("img", "inst_id", F.col("new_id").cast("int").alias("new_id"))


def relabel(pixels: DataFrame, mapping: DataFrame) -> DataFrame:
    joined = pixels.join(mapping, KEYS)
    return joined.withColumn("inst_id", F.col("new_id")).drop("new_id")


def instance_info(pixels: DataFrame, type_col: str = "pixel_type") -> DataFrame:
    """Box, centroid, size and majority type of every instance.

    The background type 0 only wins alone. Ties go to the smaller type. Types fold
    to (instance, type) counts before the majority is taken.
    """
    per_type = pixels.groupBy(*KEYS, type_col).agg(
        F.count("*").alias("c"),
        F.sum("x").alias("sx"),
        F.sum("y").alias("sy"),
        *[f(c).alias(f"{n}{c}") for c in "xy" for f, n in ((F.min, "min_"), (F.max, "max_"))],
    )
    rank = F.struct(F.col(type_col) == 0, -F.col("c"), F.col(type_col))
    size = F.sum("c")
    return per_type.groupBy(*KEYS).agg(
        size.alias("size"),
        F.min("min_y").alias("rmin"),
        F.min("min_x").alias("cmin"),
        (F.max("max_y") + 1).alias("rmax"),
        (F.max("max_x") + 1).alias("cmax"),
        ratio(F.sum("sx"), size).alias("centroid_x"),
        ratio(F.sum("sy"), size).alias("centroid_y"),
        F.min_by(type_col, rank).alias("type"),
        (F.min_by("c", rank) / (size + 1e-6)).alias("type_prob"),
    )


def block_mean(pixels: DataFrame, factor: int, value: str) -> DataFrame:
    """Mean over factor x factor blocks; missing pixels at the edges count as zero."""
    return pixels.groupBy(
        "img",
        F.floor(F.col("y") / factor).cast("int").alias("y"),
        F.floor(F.col("x") / factor).cast("int").alias("x"),
    ).agg((F.sum(value) / (factor * factor)).alias(value))


def shift(pixels: DataFrame, dy: int, dx: int) -> DataFrame:
    """Padding (positive) or cropping (negative) on the top and left."""
    return pixels.withColumn("y", F.col("y") + dy).withColumn("x", F.col("x") + dx)


def crop(pixels: DataFrame, y0: int, y1: int, x0: int, x1: int) -> DataFrame:
    """The window [y0, y1) x [x0, x1), moved to the origin. The box test is pushed down."""
    window = pixels.filter(
        (F.col("y") >= y0) & (F.col("y") < y1) & (F.col("x") >= x0) & (F.col("x") < x1)
    )
    return shift(window, -y0, -x0)


def central_crop(pixels: DataFrame, height: int, width: int, new_h: int, new_w: int) -> DataFrame:
    top, left = int((height - new_h) * 0.5), int((width - new_w) * 0.5)
    return crop(pixels, top, top + new_h, left, left + new_w)


def scale_to_byte(pixels: DataFrame, value: str) -> DataFrame:
    """0..255 by the maximum of each image; whole numbers, rounded down."""
    top = pixels.groupBy("img").agg(F.max(value).alias("_top"))
    scaled = F.floor(ratio(F.col(value), F.col("_top")) * 255).cast("int")
    return pixels.join(top, "img").withColumn(value, scaled).drop("_top")


def distance_maps(pixels: DataFrame, min_size: int = 30) -> DataFrame:
    """Horizontal and vertical offset of every pixel from its instance's centre.

    Offsets count from the rounded centre of mass; the negative and the positive
    side of each instance are scaled to -1 and 1.
    """
    def centre(c: str) -> Column:
        low = F.min(c) - 2
        return low - 1 + F.floor(F.avg(c) - low + 0.5)

    stats = pixels.groupBy(*KEYS).agg(
        F.count("*").alias("_n"),
        centre("x").alias("_cx"),
        centre("y").alias("_cy"),
        *[f(c).alias(f"_{n}{c}") for c in "xy" for f, n in ((F.min, "lo"), (F.max, "hi"))],
    ).filter(F.col("_n") >= min_size)
    joined = pixels.join(stats, KEYS)

    def scaled(c: str) -> Column:
        d = (F.col(c) - F.col(f"_c{c}")).cast("double")
        low = (F.col(f"_c{c}") - F.col(f"_lo{c}")).cast("double")
        high = (F.col(f"_hi{c}") - F.col(f"_c{c}")).cast("double")
        return F.when(d < 0, d / F.when(low != 0, low)).when(d > 0, d / F.when(high != 0, high)).otherwise(0.0)

    return joined.select("img", "y", "x", "inst_id", scaled("x").alias("h"), scaled("y").alias("v"))


def moment_features(pixels: DataFrame, intensity: str = "intensity") -> DataFrame:
    """Shape and intensity features that follow from sums over an instance's pixels."""
    x, y = F.col("x").cast("double"), F.col("y").cast("double")
    powers = {
        f"m{i}{j}": F.sum(F.pow(y - F.col("_y"), F.lit(i)) * F.pow(x - F.col("_x"), F.lit(j)))
        for i in range(4)
        for j in range(4 - i)
    }
    # Moments are taken about a pixel of the instance to keep the powers small.
    origin = pixels.groupBy(*KEYS).agg(
        F.min("x").cast("double").alias("_x"), F.min("y").cast("double").alias("_y")
    )
    raw = (
        pixels.join(origin, KEYS)
        .groupBy(*KEYS)
        .agg(
            *[v.alias(k) for k, v in powers.items()],
            ((F.max("y") - F.min("y") + 1) * (F.max("x") - F.min("x") + 1)).cast("double").alias("area_bbox"),
            F.min(intensity).alias("intensity_min"),
            F.max(intensity).alias("intensity_max"),
            F.avg(intensity).alias("intensity_mean"),
        )
    )
    m = {k: F.col(k) for k in powers}
    area = m["m00"]
    ym, xm = m["m10"] / area, m["m01"] / area
    central = raw.select(
        "*",
        (m["m20"] - ym * m["m10"]).alias("c20"),
        (m["m02"] - xm * m["m01"]).alias("c02"),
        (m["m11"] - ym * m["m01"]).alias("c11"),
        (m["m30"] - 3 * ym * m["m20"] + 2 * ym * ym * m["m10"]).alias("c30"),
        (m["m03"] - 3 * xm * m["m02"] + 2 * xm * xm * m["m01"]).alias("c03"),
        (m["m21"] - 2 * ym * m["m11"] - xm * m["m20"] + 2 * ym * ym * m["m01"]).alias("c21"),
        (m["m12"] - 2 * xm * m["m11"] - ym * m["m02"] + 2 * xm * xm * m["m10"]).alias("c12"),
    )
    c = {k: F.col(k) for k in ("c20", "c02", "c11", "c30", "c03", "c21", "c12")}
    # Inertia tensor: second moments of the other axis over the area.
    half_sum = (c["c02"] + c["c20"]) / area / 2
    half_gap = F.sqrt(F.pow((c["c02"] - c["c20"]) / area / 2, 2) + F.pow(c["c11"] / area, 2))
    big, small = half_sum + half_gap, F.greatest(half_sum - half_gap, F.lit(0.0))
    a, d, b = c["c02"] / area, c["c20"] / area, -c["c11"] / area
    orientation = F.when(
        a - d == 0, F.when(b < 0, math.pi / 4).otherwise(-math.pi / 4)
    ).otherwise(0.5 * F.atan2(-2 * b, d - a))

    def eta(k: str) -> Column:
        order = int(k[1]) + int(k[2])
        return c[k] / F.pow(area, F.lit(order / 2 + 1))

    e = {k: eta(k) for k in c}
    s, t = e["c30"] + e["c12"], e["c21"] + e["c03"]
    u, w = e["c30"] - 3 * e["c12"], 3 * e["c21"] - e["c03"]
    gap = e["c20"] - e["c02"]
    hu = [
        e["c20"] + e["c02"],
        gap * gap + 4 * e["c11"] * e["c11"],
        u * u + w * w,
        s * s + t * t,
        u * s * (s * s - 3 * t * t) + w * t * (3 * s * s - t * t),
        gap * (s * s - t * t) + 4 * e["c11"] * s * t,
        w * s * (s * s - 3 * t * t) - u * t * (3 * s * s - t * t),
    ]
    return central.select(
        *KEYS,
        area.cast("long").alias("area"),
        F.col("area_bbox").cast("long").alias("area_bbox"),
        (area / F.col("area_bbox")).alias("extent"),
        (4 * F.sqrt(big)).alias("axis_major_length"),
        (4 * F.sqrt(small)).alias("axis_minor_length"),
        F.when(big == 0, 0.0).otherwise(F.sqrt(1 - small / F.when(big != 0, big))).alias("eccentricity"),
        orientation.alias("orientation"),
        a.alias("inertia_tensor_0_0"),
        b.alias("inertia_tensor_0_1"),
        d.alias("inertia_tensor_1_1"),
        big.alias("inertia_tensor_eigvals_0"),
        small.alias("inertia_tensor_eigvals_1"),
        "intensity_min",
        "intensity_mean",
        "intensity_max",
        *[h.alias(f"moments_hu_{i}") for i, h in enumerate(hu)],
    )


def _steps(offsets: list[tuple[int, int, int]]) -> Column:
    return F.array(
        *[
            F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx"), F.lit(w).alias("w"))
            for dy, dx, w in offsets
        ]
    )


def _scatter(pixels: DataFrame, offsets: list[tuple[int, int, int]]) -> DataFrame:
    """Every pixel adds a weight to its neighbours' codes: (img, inst_id, y, x, code)."""
    return (
        pixels.select(*KEYS, "y", "x", F.explode(_steps(offsets)).alias("_s"))
        .groupBy(*KEYS, (F.col("y") + F.col("_s.dy")).alias("y"), (F.col("x") + F.col("_s.dx")).alias("x"))
        .agg(F.sum("_s.w").alias("code"))
    )


# 2 x 2 pixel patterns, their Euler numbers (8-connected) and their
# perimeter contributions along four directions.
QUADS = [(0, 0, 1), (1, 0, 2), (0, 1, 4), (1, 1, 8)]
EULER_8 = [0, 0, 0, 0, 0, 0, -1, 0, 1, 0, 0, 0, 0, 0, -1, 0]
_R = math.sqrt(2)
CROFTON_4 = [
    0,
    math.pi / 4 * (1 + 1 / _R),
    math.pi / (4 * _R),
    math.pi / (2 * _R),
    0,
    math.pi / 4 * (1 + 1 / _R),
    0,
    math.pi / (4 * _R),
    math.pi / 4,
    math.pi / 2,
    math.pi / (4 * _R),
    math.pi / (4 * _R),
    math.pi / 4,
    math.pi / 2,
    0,
    0,
]
# Border pixel patterns and their length in the perimeter estimate.
EDGE_LENGTHS = {
    5: 1.0, 7: 1.0, 15: 1.0, 17: 1.0, 25: 1.0, 27: 1.0,
    21: _R, 33: _R,
    13: (1 + _R) / 2, 23: (1 + _R) / 2,
}


def pattern_features(pixels: DataFrame) -> DataFrame:
    """Euler number, perimeter and four-direction perimeter from local patterns.

    Pixels scatter small weights to their neighbours and each position folds to one
    pattern code, so the neighbourhood is never joined.
    """
    codes = _scatter(pixels, QUADS)
    euler = F.array(*[F.lit(v) for v in EULER_8])
    crofton = F.array(*[F.lit(float(v)) for v in CROFTON_4])
    quads = codes.groupBy(*KEYS).agg(
        F.sum(F.get(euler, F.col("code").cast("int"))).alias("euler_number"),
        F.sum(F.get(crofton, F.col("code").cast("int"))).alias("perimeter_crofton"),
    )
    # A pixel with four neighbours of its instance is inside, the others are border.
    cross = [(0, 0, 100), (0, 1, 1), (0, -1, 1), (1, 0, 1), (-1, 0, 1)]
    border = _scatter(pixels, cross).filter("code >= 100 and code < 104").drop("code")
    ring = [(0, 0, 1)]
    ring += [(dy, dx, 2) for dy, dx in ((0, 1), (0, -1), (1, 0), (-1, 0))]
    ring += [(dy, dx, 10) for dy in (-1, 1) for dx in (-1, 1)]
    lengths = F.lit(0.0)
    for code, length in EDGE_LENGTHS.items():
        lengths = F.when(F.col("code") == code, length).otherwise(lengths)
    # Only odd codes sit on a border pixel.
    perimeter = _scatter(border, ring).groupBy(*KEYS).agg(F.sum(lengths).alias("perimeter"))
    return quads.join(perimeter, KEYS, "left").na.fill(0.0, ["perimeter"])


def share_of_type(pixels: DataFrame, type_col: str) -> DataFrame:
    """Share of every pixel type in each image."""
    counts = pixels.groupBy("img", type_col).agg(F.count("*").alias("n"))
    return counts.withColumn("share", ratio(F.col("n"), F.sum("n").over(Window.partitionBy("img"))))
