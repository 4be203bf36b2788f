"""Connected components, by tiles first and by label contraction between tiles."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ordering import running_sum
from ..session import cut_lineage, spread_by

AT_ONCE = 1 << 17  # rows of small groups handled together


def contract_labels(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, root): the smallest vertex of each component of an undirected graph.

    Alternating large-star and small-star rounds: every round replaces the edges by
    edges to local minima, which converges in O(log n) rounds on any graph. Each
    round is two shuffles; no component is gathered in one place.
    """
    pairs = cut_lineage(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .filter("u != v")
        .distinct()
    )
    previous = None
    for _ in range(max_rounds):
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.unionByName(low.filter("m < u").select("u", F.col("m").alias("v"))).distinct()
        small_low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(small_low, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(small_low.select("u", F.col("m").alias("v")))
            .filter("u != v")
            .distinct()
        )
        pairs = cut_lineage(small)
        state = pairs.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
        ).first()
        if previous == (state["n"], state["h"]):
            break
        previous = (state["n"], state["h"])
    else:
        raise RuntimeError("label contraction did not converge")
    roots = pairs.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "id")
    own = roots.select(F.col("root").alias("id"), "root").distinct()
    return roots.unionByName(own)


def least_reached(count: int, ends: np.ndarray) -> np.ndarray:
    """For each of ``count`` vertices the least one that it reaches over the edges ``ends`` (n, 2)."""
    root = np.arange(count)
    while True:
        reached = root[ends]
        low, high = reached.min(axis=1), reached.max(axis=1)
        apart = low < high
        if not apart.any():
            return root
        np.minimum.at(root, high[apart], low[apart])
        while not np.array_equal(root, above := root[root]):
            root = above


def _differs(column: pa.ChunkedArray) -> np.ndarray:
    """Whether each value but the first is another than the one before; nulls are alike."""
    if pa.types.is_nested(column.type):
        values = column.to_pylist()
        return np.array([a != b for a, b in zip(values[1:], values[:-1], strict=True)], dtype=bool)
    one, two = column.slice(1), column.slice(0, max(0, len(column) - 1))
    other = pc.if_else(pc.or_(pc.is_null(one), pc.is_null(two)), pc.xor(pc.is_null(one), pc.is_null(two)), pc.not_equal(one, two))
    return other.to_numpy().astype(bool)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Many whole groups at a time, and where each begins; rows come in order of ``keys``."""
    held: list[pa.RecordBatch] = []

    def begins(table: pa.Table) -> np.ndarray:
        return np.flatnonzero(np.concatenate([[True], np.logical_or.reduce([_differs(table[k]) for k in keys])]))

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= AT_ONCE:
            table = pa.Table.from_batches(held)
            starts = begins(table)
            cut = int(starts[-1])  # the last group may go on
            if cut:
                yield table.slice(0, cut), starts[:-1]
                held = table.slice(cut).to_batches()
    if held:
        table = pa.Table.from_batches(held)
        yield table, begins(table)


def _label_tiles(group: np.ndarray, y: np.ndarray, x: np.ndarray, tile: int, diagonal: bool) -> np.ndarray:
    """For each pixel the first one of its part; pixels come by group, then y, then x."""
    width = tile + 2
    code = (group * width + y % tile + 1) * width + x % tile + 1
    twice = np.flatnonzero(code[1:] == code[:-1])
    edges = [np.column_stack([twice, twice + 1])]
    for dy, dx in [(0, 1), (1, 0)] + ([(1, 1), (1, -1)] if diagonal else []):
        at = np.minimum(np.searchsorted(code, code + dy * width + dx), len(code) - 1)
        hit = np.flatnonzero(code[at] == code + dy * width + dx)
        edges.append(np.column_stack([hit, at[hit]]))
    return least_reached(len(code), np.concatenate(edges))


def mask_components(pixels: DataFrame, diagonal: bool = False, tile: int = 128) -> DataFrame:
    """Pixels with ``component``: the key of the first pixel, in scan order, of its part.

    Tiles of an instance have at most tile^2 pixels whatever the mask looks like, and a task
    labels many of them at once. Parts meet across
    tile borders through equi-joins on neighbouring border pixels, and only the
    graph of parts is contracted. Pixels of several instances may lie at one place.
    """
    keyed = pixels.select(
        "img", "y", "x", F.col("inst_id").cast("long").alias("inst_id"),
        F.floor(F.col("y") / tile).alias("ty"), F.floor(F.col("x") / tile).alias("tx"),
    )
    tiles = ["img", "inst_id", "ty", "tx"]

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, tiles):
            group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, table.num_rows)))
            y, x = (table[c].to_numpy().astype(np.int64) for c in "yx")
            # Scan order key: y major; coordinates below 2^31.
            part = ((y << 32) + x)[_label_tiles(group, y, x, tile, diagonal)]
            yield from table.select(["img", "y", "x", "inst_id"]).append_column("part", pa.array(part)).to_batches()

    kinds = dict(keyed.dtypes)
    # Keys pass through the tasks as they are, whatever their type.
    parts = cut_lineage(
        spread_by(keyed, *tiles).sortWithinPartitions(*tiles, "y", "x").mapInArrow(
            label, f"img {kinds['img']}, y {kinds['y']}, x {kinds['x']}, inst_id long, part long"
        )
    )
    low = (F.pmod("y", F.lit(tile)) == 0) | (F.pmod("x", F.lit(tile)) == 0)
    high = (F.pmod("y", F.lit(tile)) == tile - 1) | (F.pmod("x", F.lit(tile)) == tile - 1)
    rim = parts.filter(low | high)
    steps = [(0, 1), (1, 0)] + ([(1, 1), (1, -1)] if diagonal else [])
    moves = F.array(*[F.struct(F.lit(a).alias("dy"), F.lit(b).alias("dx")) for a, b in steps])
    moved = rim.select("img", "inst_id", "y", "x", F.col("part").alias("pa"), F.explode(moves).alias("_m")).select(
        "img", "inst_id", (F.col("y") + F.col("_m.dy")).alias("y"), (F.col("x") + F.col("_m.dx")).alias("x"), "pa"
    )
    touching = (
        moved.join(rim.select("img", "inst_id", "y", "x", F.col("part").alias("pb")), ["img", "inst_id", "y", "x"])
        .filter("pa != pb")
        .select(*[F.struct("img", "inst_id", F.col(p).alias("k")).alias(n) for n, p in (("a", "pa"), ("b", "pb"))])
    )
    roots = contract_labels(touching)
    joined = parts.withColumn("id", F.struct("img", "inst_id", F.col("part").alias("k"))).join(roots, "id", "left")
    return joined.select(
        "img", "y", "x", "inst_id", F.coalesce(F.col("root.k"), F.col("part")).alias("component")
    )


def split_instances(pixels: DataFrame, tile: int = 128) -> DataFrame:
    """Disconnected parts become instances of their own.

    The first part, in scan order, keeps the id; the others get new ids above the
    largest one of the image.
    """
    parts = mask_components(pixels, diagonal=True, tile=tile)
    listed = parts.select("img", "inst_id", "component").distinct()
    first = listed.groupBy("img", "inst_id").agg(F.min("component").alias("component"))
    later = listed.join(first, ["img", "inst_id", "component"], "left_anti")
    top = listed.groupBy("img").agg(F.max("inst_id").alias("_top"))
    ranked = running_sum(
        later, ["img"], F.floor(F.col("inst_id") / 4096), [F.col("inst_id"), F.col("component")], F.lit(1), "_k"
    )
    fresh = ranked.join(top, "img").select(
        "img", "inst_id", "component", (F.col("_top") + F.col("_k")).alias("_new")
    )
    return parts.join(fresh, ["img", "inst_id", "component"], "left").select(
        "img", "y", "x", F.coalesce("_new", "inst_id").alias("inst_id")
    )


def relabel(pixels: DataFrame, tile: int = 128) -> DataFrame:
    """Ids 1, 2, ... for the connected parts of an image's instances, in scan order.

    Parts touch over edges or corners; different ids never join.
    """
    parts = mask_components(pixels, diagonal=True, tile=tile)
    listed = parts.select("img", "component").distinct()
    ranked = running_sum(listed, ["img"], F.floor(F.col("component") / 65536), [F.col("component")], F.lit(1), "_new")
    return parts.join(ranked, ["img", "component"]).select("img", "y", "x", F.col("_new").cast("int").alias("inst_id"))


def hole_sizes(pixels: DataFrame, tile: int = 128) -> DataFrame:
    """(img, inst_id, holes): background pixels an instance encloses.

    The background within an instance's box is labelled in parts; a part that
    reaches the edge of the box is outside.
    """
    box = pixels.groupBy("img", "inst_id").agg(
        *[f(c).alias(f"{n}{c}") for c in "yx" for f, n in ((F.min, "lo"), (F.max, "hi"))]
    )
    filled = box.withColumn("y", F.explode(F.sequence("loy", "hiy"))).withColumn(
        "x", F.explode(F.sequence("lox", "hix"))
    )
    empty = filled.join(pixels.select("img", "inst_id", "y", "x"), ["img", "inst_id", "y", "x"], "left_anti")
    # Boxes of neighbours overlap; a component is one within an instance's own box.
    keyed = mask_components(empty.select("img", "inst_id", "y", "x"), diagonal=False, tile=tile)
    edge = (
        (F.col("y") == F.col("loy")) | (F.col("y") == F.col("hiy"))
        | (F.col("x") == F.col("lox")) | (F.col("x") == F.col("hix"))
    )
    per_part = keyed.join(box, ["img", "inst_id"]).groupBy("img", "inst_id", "component").agg(
        F.count("*").alias("c"), F.max(edge).alias("outside")
    )
    return per_part.filter("not outside").groupBy("img", "inst_id").agg(F.sum("c").alias("holes"))


def _chains(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two chains of the hull of (y, x) points, each from the least y to the largest."""
    points = sorted(set(map(tuple, points.tolist())))

    def side(sign: float) -> np.ndarray:
        chain: list[tuple[float, float]] = []
        for p in points:
            while len(chain) > 1:
                a, b = chain[-2], chain[-1]
                if sign * ((b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0])) < 0:
                    chain.pop()
                else:
                    break
            chain.append(p)
        return np.array(chain)

    return side(1.0), side(-1.0)


def _midpoints(y: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """(y, x) of the edge midpoints of the outermost pixels of each row."""
    sides = ((y, low - 0.5), (y, high + 0.5), (y - 0.5, low), (y + 0.5, low), (y - 0.5, high), (y + 0.5, high))
    return np.stack([np.stack(side, axis=1) for side in sides], axis=1)


def _pixels_within(points: np.ndarray) -> int:
    """Pixels whose centre lies in the hull of (y, x) points.

    Chains run along y, so each row of pixels meets either chain once.
    """
    left, right = _chains(points)
    scan = np.arange(left[0, 0] + 0.5, left[-1, 0])
    a, b = np.interp(scan, left[:, 0], left[:, 1]), np.interp(scan, right[:, 0], right[:, 1])
    return int((np.floor(np.maximum(a, b) + 1e-9) - np.ceil(np.minimum(a, b) - 1e-9) + 1).sum())


def convex_areas(pixels: DataFrame, band: int = 256) -> DataFrame:
    """(img, inst_id, area, area_convex).

    Pixels fold to the two ends of each row, bands of rows to the corners of their own
    hulls, and these are merged: a hull of hulls is the hull. The last step sees the few
    corners of each band, however large the instance is.
    """
    ends = pixels.groupBy("img", "inst_id", "y").agg(
        F.min("x").alias("lo"), F.max("x").alias("hi"), F.count("*").alias("n")
    )
    kinds = dict(pixels.dtypes)
    key = f"img {kinds['img']}, inst_id {kinds['inst_id']}"
    own, bands = ["img", "inst_id"], ["img", "inst_id", "band"]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, bands):
            points = _midpoints(*[table[c].to_numpy().astype(float) for c in ("y", "lo", "hi")])
            stops = np.append(starts[1:], table.num_rows)
            hulls = [
                np.unique(np.concatenate(_chains(points[i:j].reshape(-1, 2))), axis=0)
                for i, j in zip(starts.tolist(), stops.tolist(), strict=True)
            ]
            counts = np.array([len(h) for h in hulls])
            corners, n = np.concatenate(hulls), np.zeros(counts.sum(), np.int64)
            n[np.cumsum(counts) - counts] = np.add.reduceat(table["n"].to_numpy(), starts)
            out = table.select(own).take(pa.array(np.repeat(starts, counts)))
            for name, column in (("py", corners[:, 0]), ("px", corners[:, 1]), ("n", n)):
                out = out.append_column(name, pa.array(column))
            yield from out.to_batches()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, own):
            points = np.column_stack([table["py"].to_numpy(), table["px"].to_numpy()])
            stops = np.append(starts[1:], table.num_rows)
            convex = [_pixels_within(points[i:j]) for i, j in zip(starts.tolist(), stops.tolist(), strict=True)]
            out = table.select(own).take(pa.array(starts))
            out = out.append_column("area", pa.array(np.add.reduceat(table["n"].to_numpy(), starts)))
            yield from out.append_column("area_convex", pa.array(convex, pa.int64())).to_batches()

    banded = ends.withColumn("band", F.floor(F.col("y") / band))
    corners = spread_by(banded, *bands).sortWithinPartitions(*bands).mapInArrow(partial, f"{key}, py double, px double, n long")
    return spread_by(corners, *own).sortWithinPartitions(*own).mapInArrow(merge, f"{key}, area long, area_convex long")


def hull_features(pixels: DataFrame, tile: int = 128, band: int = 256) -> DataFrame:
    """(img, inst_id, area, area_convex, area_filled, solidity)."""
    holes = hole_sizes(pixels, tile)
    return convex_areas(pixels, band).join(holes, ["img", "inst_id"], "left").select(
        "img", "inst_id", "area", "area_convex",
        (F.col("area") + F.coalesce("holes", F.lit(0))).alias("area_filled"),
        (F.col("area") / F.col("area_convex")).alias("solidity"),
    )


def mask_polygons(pixels: DataFrame, tile: int = 128) -> DataFrame:
    """(img, cell_ids, cell_x, cell_y, area) of the first part of every instance.

    Parts joined only by a corner are separate; the one met first in scan order is
    the cell. Centroids are those of the pixel squares.
    """
    parts = mask_components(pixels, diagonal=False, tile=tile)
    stats = parts.groupBy("img", "inst_id", "component").agg(
        F.count("*").alias("area"),
        (F.avg("x") + 0.5).alias("cell_x"),
        (F.avg("y") + 0.5).alias("cell_y"),
    )
    return stats.groupBy("img", F.col("inst_id").alias("cell_ids")).agg(
        F.min_by(F.struct("cell_x", "cell_y", "area", "component"), F.col("component")).alias("_p")
    ).select("img", "cell_ids", "_p.cell_x", "_p.cell_y", "_p.area", "_p.component")


SIDES = [((0, 0), (1, 0)), ((1, 0), (1, 1)), ((1, 1), (0, 1)), ((0, 1), (0, 0))]  # of a pixel, inside on one hand


def _side_key(x: Column, y: Column, way: Column) -> Column:
    """A side by its first corner, y before x, and its direction; x below 2^31, y below 2^29."""
    return F.shiftleft(y.cast("long"), 33) + F.shiftleft(x.cast("long"), 2) + way.cast("long")


def _outline_sides(pixels: DataFrame, tile: int) -> DataFrame:
    """(img, cell_ids, e, way, x1, y1, x2, y2): sides of the first part of every instance.

    Those shared by two pixels of the part cancel in an aggregation.
    """
    parts = mask_components(pixels, diagonal=False, tile=tile)
    first = parts.groupBy("img", "inst_id").agg(F.min("component").alias("component"))
    kept = parts.join(first, ["img", "inst_id", "component"])
    listed = F.array(
        *[
            F.struct(F.lit(way).alias("way"), *[F.lit(v).alias(n) for v, n in zip((*a, *b), ("x1", "y1", "x2", "y2"))])
            for way, (a, b) in enumerate(SIDES)
        ]
    )
    sides = kept.select("img", F.col("inst_id").alias("cell_ids"), "y", "x", F.explode(listed).alias("_s")).select(
        "img", "cell_ids", F.col("_s.way").alias("way"),
        *[(F.col(n[0]) + F.col(f"_s.{n}")).cast("long").alias(n) for n in ("x1", "y1", "x2", "y2")],
    )
    start = F.struct(F.col("x1").alias("x"), F.col("y1").alias("y"))
    end = F.struct(F.col("x2").alias("x"), F.col("y2").alias("y"))
    return (
        sides.groupBy("img", "cell_ids", F.least(start, end).alias("_l"), F.greatest(start, end).alias("_h"))
        .agg(F.count("*").alias("c"), *[F.first(n).alias(n) for n in ("way", "x1", "y1", "x2", "y2")])
        .filter("c = 1")
        .select("img", "cell_ids", _side_key(F.col("x1"), F.col("y1"), F.col("way")).alias("e"), "way", "x1", "y1", "x2", "y2")
    )


def outline_corners(pixels: DataFrame, tile: int = 128) -> DataFrame:
    """(img, cell_ids, left, x, y): corners of the outer ring of every instance's first part.

    ``left`` is the number of unit sides from the corner on to the ring's end, plus one;
    the ring runs down to 1, which is the corner it begins at, the first in scan order.
    Places along a ring come from pointer doubling: in each round every side learns where
    twice as many steps lead, so rings of n sides need log2(n) joins and no task holds a
    whole ring. At a corner where a part touches itself the ring stays with the pixel.
    """
    own = ["img", "cell_ids"]
    sides = cut_lineage(_outline_sides(pixels, tile))
    bits = F.array(*[F.lit(1 << way) for way in range(4)])
    leaving = sides.groupBy(*own, F.col("x1").alias("x2"), F.col("y1").alias("y2")).agg(
        F.bit_or(F.element_at(bits, F.col("way") + 1)).alias("ways")
    )
    inward = F.pmod(F.col("way") + 1, F.lit(4))
    onward = F.when(
        F.col("ways").bitwiseAND(F.element_at(bits, inward + 1)) != 0, inward
    ).otherwise(F.array_position(bits, F.col("ways")).cast("int") - 1)
    heads = sides.groupBy(*own).agg(F.min("e").alias("head"), F.count("*").alias("n"))
    to = _side_key(F.col("x2"), F.col("y2"), F.col("_next"))
    hops = cut_lineage(
        sides.join(leaving, [*own, "x2", "y2"])
        .withColumn("_next", onward)
        .join(heads, own)
        .select(
            *own, "e", "n", F.when(to != F.col("head"), to).alias("to"), F.lit(1).cast("long").alias("left"),
            F.when(F.col("way") != F.col("_next"), F.struct(F.col("x2").alias("x"), F.col("y2").alias("y"))).alias("corner"),
        )
    )
    ready, covered = [], 1
    while True:
        # Of rings this short all sides know the end; those that do not are sides of holes.
        ready.append(hops.filter((F.col("n") <= covered) & F.col("to").isNull() & F.col("corner").isNotNull()))
        hops = hops.filter(F.col("n") > covered)
        if not hops.take(1):
            break
        ahead = hops.select(*own, F.col("e").alias("_at"), F.col("to").alias("_to"), F.col("left").alias("_left"))
        # Sides that know the end look for a key that is not there, each for its own.
        step = hops.withColumn("_at", F.coalesce("to", -1 - F.col("e"))).join(ahead, [*own, "_at"], "left")
        hops = cut_lineage(
            step.select(
                *own, "e", "n", F.col("_to").alias("to"),
                (F.col("left") + F.coalesce("_left", F.lit(0))).alias("left"), "corner",
            )
        )
        covered *= 2
    return reduce(DataFrame.unionByName, ready).select(*own, "left", "corner.x", "corner.y")


def mask_rings(pixels: DataFrame, tile: int = 128) -> DataFrame:
    """(img, cell_ids, polygon) WKT outlines of the first part of every instance."""
    ring = F.sort_array(F.collect_list(F.struct((-F.col("left")).alias("k"), "x", "y")))
    closed = F.concat(F.slice("ring", -1, 1), F.col("ring"))
    text = F.concat_ws(", ", F.transform(closed, lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string"))))
    return outline_corners(pixels, tile).groupBy("img", "cell_ids").agg(ring.alias("ring")).select(
        "img", "cell_ids", F.concat(F.lit("POLYGON (("), text, F.lit("))")).alias("polygon")
    )
