"""Tile geometry and the merging of per-tile instance masks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ordering import running_sum
from ..session import cut_lineage


def _grid(frame: DataFrame, ys: Column, xs: Column) -> DataFrame:
    return frame.withColumn("y0", F.explode(ys)).withColumn("x0", F.explode(xs))


def patch_grid(images: DataFrame, patch: int, step: int) -> DataFrame:
    """Whole patches of every image: (row, col, y0, y1, x0, x1).

    ``images`` has (img, height, width); patches that do not fit are left out.
    """
    def starts(length: str) -> Column:
        last = F.floor((F.col(length) - patch) / step).cast("int")
        return F.when(F.col(length) >= patch, F.transform(
            F.sequence(F.lit(0), last), lambda i: i * step)).otherwise(F.array().cast("array<int>"))

    grid = _grid(images, starts("height"), starts("width"))
    return grid.select(
        "img",
        (F.col("y0") / step).cast("int").alias("row"),
        (F.col("x0") / step).cast("int").alias("col"),
        "y0",
        (F.col("y0") + patch).alias("y1"),
        "x0",
        (F.col("x0") + patch).alias("x1"),
    )


def padded_length(height: int, width: int, patch: int, step: int) -> int:
    """Side of the square that whole steps of patches cover for an image."""
    return (max(height, width) // step - 1) * step + patch


def _starts(length: Column, window: int, out: int) -> Column:
    """Starts of output windows so that the last one reaches past the end."""
    margin = window - out
    steps = F.floor((length - margin) / out).cast("int") + 1
    return F.transform(F.sequence(F.lit(0), steps - 1), lambda i: i * out + margin // 2)


def output_windows(images: DataFrame, window: int, out: int) -> DataFrame:
    """Input and output corners of inference windows whose outputs tile the image."""
    grid = _grid(images, _starts(F.col("height"), window, out), _starts(F.col("width"), window, out))
    half = (window - out) // 2
    return grid.select(
        "img",
        F.col("y0").alias("out_y"),
        F.col("x0").alias("out_x"),
        (F.col("y0") - half).alias("in_y"),
        (F.col("x0") - half).alias("in_x"),
    )


def processing_tiles(images: DataFrame, tile: int, ambiguous: int) -> DataFrame:
    """Tiles for post-processing: the grid, strips over its seams, and its crossings.

    ``phase`` is 0 for the grid, 1 for strips over vertical seams, 2 for strips over
    horizontal seams and 3 for crossings; strips and crossings are processed later
    and overwrite what the seams cut.
    """
    base = images.withColumn("ys", _starts(F.col("height"), tile, tile)).withColumn(
        "xs", _starts(F.col("width"), tile, tile)
    )

    def cut(c: str) -> Column:
        inner = F.slice(F.col(c), F.lit(2), F.greatest(F.size(c) - 1, F.lit(0)))
        return inner

    def part(phase: int, ys: Column, xs: Column, grow_y: int, grow_x: int) -> DataFrame:
        grid = _grid(base, ys, xs)
        high = F.col("y0") + (grow_y if phase in (2, 3) else tile)
        wide = F.col("x0") + (grow_x if phase in (1, 3) else tile)
        low_y = F.col("y0") - grow_y if phase in (2, 3) else F.col("y0")
        low_x = F.col("x0") - grow_x if phase in (1, 3) else F.col("x0")
        if phase == 0:
            high, wide = F.least(high, F.col("height")), F.least(wide, F.col("width"))
        return grid.select(
            "img",
            F.lit(phase).alias("phase"),
            low_y.alias("y0"),
            high.alias("y1"),
            low_x.alias("x0"),
            wide.alias("x1"),
        )

    return (
        part(0, F.col("ys"), F.col("xs"), 0, 0)
        .unionByName(part(1, F.col("ys"), cut("xs"), 0, ambiguous))
        .unionByName(part(2, cut("ys"), F.col("xs"), ambiguous, 0))
        .unionByName(part(3, cut("ys"), cut("xs"), 2 * ambiguous, 2 * ambiguous))
    )


def _covering(c: str, patch: int, step: int) -> Column:
    """Indices of the patches of a regular grid that cover a coordinate."""
    first = F.greatest(F.floor((F.col(c) - patch) / step) + 1, F.lit(0)).cast("int")
    return F.sequence(first, F.floor(F.col(c) / step).cast("int"))


def pixel_tiles(pixels: DataFrame, patch: int, step: int) -> DataFrame:
    """Every pixel with every tile that covers it (at most (patch / step)^2 each)."""
    return pixels.withColumn("row", F.explode(_covering("y", patch, step))).withColumn(
        "col", F.explode(_covering("x", patch, step))
    )


def valid_tiles(grid: DataFrame, mask: DataFrame, patch: int, step: int) -> DataFrame:
    """Tiles that hold at least one mask pixel."""
    hit = pixel_tiles(mask.select("img", "y", "x"), patch, step).select("img", "row", "col")
    return grid.join(hit.distinct(), ["img", "row", "col"], "left_semi")


def chunk_patches(chunks: DataFrame, patches: DataFrame, patch: int, step: int) -> DataFrame:
    """(img, chunk, patch corners) of patches that lie wholly inside a chunk.

    Patches sit on a regular grid, so a chunk lists its patches by arithmetic and
    an equi-join keeps the ones that exist.
    """
    def inside(low: str, high: str) -> Column:
        first = F.ceil(F.col(low) / step).cast("int")
        last = F.floor((F.col(high) - patch) / step).cast("int")
        return F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))

    listed = chunks.select(
        "img",
        F.col("chunk"),
        F.explode(inside("cy0", "cy1")).alias("row"),
        "cx0",
        "cx1",
    ).withColumn("col", F.explode(inside("cx0", "cx1"))).drop("cx0", "cx1")
    return listed.join(patches, ["img", "row", "col"])


def unique_ids(pixels: DataFrame, tile: Iterable[str] = ("row", "col")) -> DataFrame:
    """Ids made dense within each tile and offset by the counts of the tiles before.

    ``pixels`` has (img, row, col, y, x, inst_id); tiles count in row-major order.
    """
    tile = list(tile)
    ids = pixels.select("img", *tile, "inst_id").distinct()
    # Dense numbering in (row, col, id) order is the offset plus the rank in one scan.
    ranked = running_sum(
        ids,
        ["img"],
        F.col(tile[0]).cast("long"),
        [F.col(c) for c in [*tile, "inst_id"]],
        F.lit(1),
        "new_id",
    )
    return (
        pixels.join(ranked, ["img", *tile, "inst_id"])
        .withColumn("inst_id", F.col("new_id").cast("int"))
        .drop("new_id")
    )


def stitch(
    pixels: DataFrame, rows: int, cols: int, patch: int, step: int, min_pixels: int = 4
) -> DataFrame:
    """One mask per image from overlapping patches: (img, y, x, inst_id).

    ``pixels`` has (img, row, col, dy, dx, inst_id) with offsets inside the patch.
    Ids become unique, small instances go, patches of even and odd columns form two
    layers, and where layers overlap only the largest instance stays (the even
    layer wins ties). Within a layer a later patch overwrites an earlier one, also
    with background.
    """
    distinct = unique_ids(pixels)
    sizes = distinct.groupBy("img", "inst_id").agg(F.count("*").alias("size"))
    sized = distinct.join(sizes.filter(F.col("size") >= min_pixels), ["img", "inst_id"])
    placed = (
        sized.withColumn("y", F.col("row") * step + F.col("dy"))
        .withColumn("x", F.col("col") * step + F.col("dx"))
        .withColumn("layer", F.col("col") % 2)
    )
    last_row = F.least(F.floor(F.col("y") / step), F.lit(rows - 1))
    last_col = F.least(F.floor(F.col("x") / step), F.lit(cols - 1))
    last_col = last_col - F.when(last_col % 2 == F.col("layer"), 0).otherwise(1)
    visible = placed.filter((F.col("row") == last_row) & (F.col("col") == last_col))
    # At most one id per layer meets at a position.
    met = (
        visible.groupBy("img", "y", "x")
        .agg(F.collect_list(F.struct((-F.col("size")).alias("s"), "layer", "inst_id")).alias("_ids"))
        .filter(F.size("_ids") > 1)
        .select("img", F.slice(F.sort_array("_ids"), 2, F.size("_ids")).alias("_rest"))
    )
    beaten = met.select("img", F.explode("_rest").alias("_r")).select(
        "img", F.col("_r.inst_id").alias("inst_id")
    ).distinct()
    return visible.join(beaten, ["img", "inst_id"], "left_anti").select("img", "y", "x", "inst_id")


def replace_in_tiles(existing: DataFrame, fresh: DataFrame, tiles: DataFrame) -> DataFrame:
    """One repair phase: inside each tile, new instances replace those cut by seams.

    ``existing`` (img, y, x, inst_id), ``fresh`` (img, tile, y, x, inst_id) and
    ``tiles`` (img, tile, y0, y1, x0, x1), not overlapping within the phase.
    Existing instances wholly inside a tile go; those touching its edge stay, and
    new instances overlapping what stays are dropped. New ids follow the largest
    existing id of the image.
    """
    from .spatial import box_join

    boxes = tiles.select(
        "img",
        "tile",
        "y0",
        "y1",
        "x0",
        "x1",
        F.col("x0").cast("double").alias("_x0"),
        F.col("y0").cast("double").alias("_y0"),
        (F.col("x1") - 1).cast("double").alias("_x1"),
        (F.col("y1") - 1).cast("double").alias("_y1"),
    )
    inside = box_join(existing, boxes, "x", "y", 64.0, by=["img"])
    on_edge = (
        (F.col("y") == F.col("y0"))
        | (F.col("y") == F.col("y1") - 1)
        | (F.col("x") == F.col("x0"))
        | (F.col("x") == F.col("x1") - 1)
    )
    status = inside.groupBy("img", "tile", "inst_id").agg(F.max(on_edge).alias("edge"))
    removed = status.filter("not edge").select("img", "inst_id").distinct()
    kept = existing.join(removed, ["img", "inst_id"], "left_anti")
    overlapping = (
        fresh.join(kept.select("img", "y", "x"), ["img", "y", "x"], "left_semi")
        .select("img", "tile", "inst_id")
        .distinct()
    )
    usable = fresh.join(overlapping, ["img", "tile", "inst_id"], "left_anti")
    top = existing.groupBy("img").agg(F.max("inst_id").alias("_top"))
    ids = running_sum(
        usable.select("img", "tile", "inst_id").distinct(),
        ["img"],
        F.col("tile").cast("long"),
        [F.col("tile"), F.col("inst_id")],
        F.lit(1),
        "_rank",
    )
    added = (
        usable.join(ids, ["img", "tile", "inst_id"])
        .join(top, "img", "left")
        .select(
            "img", "y", "x",
            (F.coalesce("_top", F.lit(0)) + F.col("_rank")).cast("int").alias("inst_id"),
        )
    )
    return kept.select("img", "y", "x", "inst_id").unionByName(added)


def merge_phases(fresh: DataFrame, tiles: DataFrame, phases: Iterable[int] = (1, 2, 3)) -> DataFrame:
    """The whole merge of tiled predictions: (img, y, x, inst_id).

    ``fresh`` (img, phase, tile, y, x, inst_id) has the instances found in every tile and
    ``tiles`` (img, phase, tile, y0, y1, x0, x1) where the tiles lie, as
    ``processing_tiles`` gives them with a number each. Phase 0 is placed as it is, with
    ids unique in its image. Then each phase repairs what the one before left: strips over
    the seams of the grid, and last the crossings of the seams. Tiles of one phase do not
    overlap, so a phase is one step for all of them; its result is written, as the next
    phase reads it several times.
    """
    merged = unique_ids(fresh.filter("phase = 0"), ["tile"]).select("img", "y", "x", "inst_id")
    for phase in phases:
        now = F.col("phase") == phase
        merged = replace_in_tiles(cut_lineage(merged), fresh.filter(now).drop("phase"), tiles.filter(now).drop("phase"))
    return merged


def reassemble(patches: DataFrame, size: int, height: int, width: int) -> DataFrame:
    """Patch predictions placed on the full map and cropped to the source."""
    placed = patches.select(
        "img",
        (F.col("row") * size + F.col("dy")).alias("y"),
        (F.col("col") * size + F.col("dx")).alias("x"),
        "value",
    )
    return placed.filter((F.col("y") < height) & (F.col("x") < width))


def images_frame(spark: SparkSession, sizes: Iterable[tuple[int, int, int]]) -> DataFrame:
    return spark.createDataFrame(list(sizes), "img long, height int, width int")
