"""How often cell types meet at each distance.

All ordered pairs of cells count, up to the largest radius. Cells lie in a tree: squares
of a pyramid hold blocks of a bounded number of cells, a block holds nodes of a few cells
each, and a node holds its cells. Pairs are followed down this tree on both sides at
once. Where the smallest and the largest distance of two blocks, or of two nodes, fall
into one band, the product of their type counts is booked and nothing below is opened;
only what lies astride a limit goes on, at last to pairs of cells.

Blocks meet by their bounds and counts alone. Coordinates are sent for pairs of groups of
neighbouring blocks, with the list of their block pairs astride a limit, so a block is sent
once for each group near it and not once for each block. No pair of nodes or cells leaves a
task: what does is a small count table per slide.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, spread_by

BLOCK_ROWS = 4096  # cells of a block at most, where a tile has no more
LEVELS = 8  # a block spans at most 2^LEVELS tiles a side
GROUP_STEPS = 3  # a group is a square of at most 2^GROUP_STEPS blocks a side
NODE_CELLS = 16
MOST_FLAT = 3
STRIP, PAIRS = 24, 96  # left nodes, and pairs of nodes, at once: tables stay in the processor's cache
APART = 1.5  # widths between the centres of two blocks that are measured in strips
MOST_STRIPS, MEASURED = 64, 1 << 14  # strips of a block, and pairs measured at once
SLACK = 1e-7  # share of a limit
OPEN_SLIDES = 32  # count tables a task holds before it emits them; the sums come later


def radii(n_intervals: int = 60) -> list[int]:
    """Radii int((i / 2)^3); bands lie between consecutive ones."""
    return [int((0.5 * i) ** 3) for i in range(1, n_intervals)]


def _blocks(cells: DataFrame, by: list[str], tile: float, block_rows: int) -> DataFrame:
    """Blocks of cells: the largest square of the pyramid with at most ``block_rows`` cells.

    A tile, the smallest square, that holds more is split by a hash of its cells.
    """
    tiled = cells.select(
        *by,
        F.col("cell_x").cast("double").alias("x"),
        F.col("cell_y").cast("double").alias("y"),
        F.col("type_code").alias("t"),
        "n_types",
        F.floor(F.col("cell_x") / tile).alias("tx"),
        F.floor(F.col("cell_y") / tile).alias("ty"),
        F.xxhash64("cell_ids").alias("h"),
    )
    keys = [*by, "tx", "ty"]
    sizes = tiled.groupBy(*keys).agg(F.count("*").alias("n"))
    square = [F.expr(f"shiftright({c}, level)").alias(f"b{c}") for c in ("tx", "ty")]
    above = sizes.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(LEVELS)))).select("*", *square)
    fits = above.groupBy(*by, "level", "btx", "bty").agg(F.sum("n").alias("held")).filter(F.col("held") <= block_rows)
    same = reduce(and_, [F.col(f"a.{c}").eqNullSafe(F.col(f"f.{c}")) for c in (*by, "level", "btx", "bty")])
    largest = (
        above.alias("a").join(fits.alias("f"), same, "left")
        .groupBy(*[F.col(f"a.{c}").alias(c) for c in keys])
        .agg(
            F.coalesce(F.max("f.level"), F.lit(0)).alias("level"),
            F.ceil(F.max(F.when(F.col("a.level") == 0, F.col("n"))) / block_rows).alias("parts"),
        )
    )
    on = reduce(and_, [F.col(f"c.{c}").eqNullSafe(F.col(f"s.{c}")) for c in keys])
    placed = tiled.alias("c").join(largest.alias("s"), on).select("c.*", "level", "parts").select(
        "*", *square, F.pmod("h", "parts").alias("part")
    )
    return placed.groupBy(*by, "level", "btx", "bty", "part").agg(
        F.collect_list("x").alias("xs"),
        F.collect_list("y").alias("ys"),
        F.collect_list("t").alias("ts"),
        F.any_value("n_types").alias("n_types"),
        F.min("x").alias("x0"),
        F.max("x").alias("x1"),
        F.min("y").alias("y0"),
        F.max("y").alias("y1"),
    )


def _grouped(blocks: DataFrame, by: list[str], waves: int) -> DataFrame:
    """Add ``square``, the group of a block: a square of blocks of one level (and part).

    Groups are as large as leaves some pairs of them to each of ``waves`` tasks a core.
    """
    tasks = waves * blocks.sparkSession.sparkContext.defaultParallelism
    held = max(1.0, blocks.count() / math.sqrt(2 * tasks))
    steps = min(GROUP_STEPS, int(math.log(held, 4)))
    return blocks.withColumn(
        "square", F.struct(*by, "level", *[F.shiftright(c, steps).alias(c) for c in ("btx", "bty")], "part")
    )


class Nodes:
    """Cells of a block in nodes of NODE_CELLS: strips by x, cut by y. The last node is filled up.

    Nodes are about 4^``flat`` times as wide as high. A filling repeats a cell under the type
    after the last one, which is not counted.
    """

    def __init__(self, x: np.ndarray, y: np.ndarray, t: np.ndarray, kinds: int, flat: int = 0):
        n = len(x)
        wide = NODE_CELLS * max(1, int(np.ceil(np.sqrt(n * 4.0**flat / NODE_CELLS))))
        strip = np.empty(n, np.int64)
        strip[np.argsort(x, kind="stable")] = np.arange(n) // wide
        order = np.lexsort((y, strip))
        order = np.concatenate([order, np.repeat(order[-1:], -n % NODE_CELLS)])
        kind = t[order].astype(np.int64)
        kind[n:] = kinds
        # cell of the node x node: the long axis comes last
        self.x, self.y, self.t = (np.ascontiguousarray(v.reshape(-1, NODE_CELLS).T) for v in (x[order], y[order], kind))
        self.x0, self.x1 = self.x.min(axis=0), self.x.max(axis=0)
        self.y0, self.y1 = self.y.min(axis=0), self.y.max(axis=0)
        nodes = self.x.shape[1]
        self.hist = np.zeros((nodes, kinds + 1), np.float32)  # whole numbers up to NODE_CELLS
        np.add.at(self.hist, (np.repeat(np.arange(nodes), NODE_CELLS), kind), 1)


class Group:
    """Blocks of one group; their nodes are built when a pair asks for them.

    Nodes lie across the line between the two blocks of a pair: the thinner they are along
    it, the fewer pairs of nodes are astride a limit.
    """

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, x: np.ndarray, y: np.ndarray, t: np.ndarray, kinds: int):
        ends = np.cumsum(sizes)
        self.cells = {b: (x[e - n : e], y[e - n : e], t[e - n : e]) for b, e, n in zip(ids, ends, sizes)}
        self.centre = {b: (x_.mean(), y_.mean()) for b, (x_, y_, _) in self.cells.items()}
        self.kinds = kinds
        self.built: dict[tuple[int, int], Nodes] = {}

    def nodes(self, block: int, flat: int) -> Nodes:
        if (block, flat) not in self.built:
            self.built[block, flat] = Nodes(*self.cells[block], self.kinds, flat)
        return self.built[block, flat]

    def flat(self, block: int, other: Group, second: int) -> int:
        (ax, ay), (bx, by) = self.centre[block], other.centre[second]
        return int(np.clip(round(math.log2((abs(ay - by) + 1e-9) / (abs(ax - bx) + 1e-9))), -MOST_FLAT, MOST_FLAT))


class Bands:
    """Bands as 0 (within the first limit), 1 to n and, beyond the last limit, n + 1.

    ``code`` has the band of every rounded-up distance; the squared distances of bands up
    to k are those up to ``square[k]``, the largest number whose root is within the limit.
    """

    def __init__(self, limits: np.ndarray):
        self.n, self.limits = len(limits) - 1, limits
        upto = np.arange(int(limits[-1]) + 2)
        self.code = np.searchsorted(limits, upto, side="left").astype(np.int64)
        self.square = np.square(limits)
        while (more := np.sqrt(np.nextafter(self.square, np.inf)) <= limits).any():
            self.square = np.where(more, np.nextafter(self.square, np.inf), self.square)

    def of(self, square: np.ndarray) -> np.ndarray:
        """Bands of squared distances, which are overwritten."""
        np.sqrt(square, out=square)
        np.ceil(square, out=square)
        np.minimum(square, len(self.code) - 1, out=square)
        return self.code[square.astype(np.int32)]


def _squares(dx: np.ndarray, dy: np.ndarray) -> np.ndarray:
    dx *= dx
    dy *= dy
    dx += dy
    return dx


def _apart(a0: np.ndarray, a1: np.ndarray, b0: np.ndarray, b1: np.ndarray) -> np.ndarray:
    out = np.maximum(a0[:, None] - b1, b0 - a1[:, None])
    return np.maximum(out, 0.0, out=out)


def _across(a0: np.ndarray, a1: np.ndarray, b0: np.ndarray, b1: np.ndarray) -> np.ndarray:
    return np.maximum(a1[:, None] - b0, b1 - a0[:, None])


def _measure(left: Nodes, right: Nodes, bands: Bands, kinds: int) -> np.ndarray:
    """Pairs (left, right) by band and types.

    Rounding is monotone, so bounds of boxes hold for the distances computed from cells.
    """
    wide = kinds + 1
    hits = np.zeros((bands.n + 2, wide, wide))
    counted = np.zeros(hits.size, np.int64)
    for start in range(0, len(left.x0), STRIP):
        at = slice(start, start + STRIP)
        ax, ay = (left.x0[at], left.x1[at]), (left.y0[at], left.y1[at])
        first = bands.of(_squares(_apart(*ax, right.x0, right.x1), _apart(*ay, right.y0, right.y1)))
        last = bands.of(_squares(_across(*ax, right.x0, right.x1), _across(*ay, right.y0, right.y1)))
        whole = np.where(first == last, first, -1)
        for k in range(int(first.min()), int(last.max()) + 1):
            hits[k] += left.hist[at].T.astype(float) @ ((whole == k).astype(np.float32) @ right.hist)
        a, b = np.nonzero(whole < 0)
        low, limits = first[a, b], last[a, b] - first[a, b]
        a += start
        for one in (True, False):  # astride a single limit, or more of them
            which = np.flatnonzero((limits == 1) == one)
            for chunk in range(0, len(which), PAIRS):
                some = which[chunk : chunk + PAIRS]
                u, v, k = a[some], b[some], low[some]
                lx, ly, kind = left.x[:, u], left.y[:, u], left.t[:, u] * wide
                rx, ry, other = right.x[:, v], right.y[:, v], right.t[:, v]
                square = _squares(lx[:, None] - rx, ly[:, None] - ry)
                if one:  # a comparison tells the lower band from the upper one
                    kind += k * (wide * wide)
                    cell = (square > bands.square[k]) * np.int64(wide * wide)
                else:
                    cell = bands.of(square)
                    cell *= wide * wide
                cell += kind[:, None]
                cell += other
                counted += np.bincount(cell.ravel(), minlength=len(counted))
    total = hits.astype(np.int64) + counted.reshape(hits.shape)
    return total[1 : bands.n + 1, :kinds, :kinds]


class Seen:
    """Two blocks in the frame of the line from the centre of the first to that of the second.

    ``s`` runs along the line, ``t`` across it.
    """

    def __init__(self, left: tuple[np.ndarray, ...], right: tuple[np.ndarray, ...]):
        (ax, ay, _), (bx, by, _) = left, right
        x, y = ax.mean(), ay.mean()
        dx, dy = bx.mean() - x, by.mean() - y
        self.far = math.hypot(dx, dy)
        dx, dy = (dx / self.far, dy / self.far) if self.far else (1.0, 0.0)
        self.s, self.t = zip(*((u * dx + v * dy, v * dx - u * dy) for u, v in ((ax - x, ay - y), (bx - x, by - y))))
        self.wide = max(float(np.ptp(t)) for t in self.t)

    def apart(self) -> bool:
        """Whether an arc around a cell of one block is nearly straight in the other, and all of it ahead."""
        return self.far >= APART * self.wide and self.s[0].max() < self.s[1].min()

    def strips(self, cells: int) -> int:
        """Strips that balance the search in them against the pairs left to measure."""
        deep = max(float(np.ptp(self.s[1])), 1e-9)
        return int(np.clip(math.sqrt(self.wide / self.far * self.wide / deep * cells / 6), 1, max(1, min(MOST_STRIPS, cells))))


def _measure_apart(
    left: tuple[np.ndarray, ...], right: tuple[np.ndarray, ...], seen: Seen, bands: Bands, kinds: int
) -> np.ndarray:
    """Pairs (left, right) by band and types, for blocks that ``seen.apart()``.

    The right block lies in strips across the line, each ordered along it. Within a limit of
    a cell lie the cells of a strip up to some place; from the bounds of the strip follow a
    place before which all are within and one after which none is, both looked up in a table.
    Cells up to the first are counted by type from running totals, those between are measured. ``SLACK``
    covers the rounding of the frame.
    """
    order = np.argsort(seen.s[0])
    ax, ay, kind = (v[order] for v in left)
    along, across = seen.s[0][order], seen.t[0][order]
    m, size = seen.strips(len(right[0])), len(right[0])
    strip = np.empty(size, np.int64)
    strip[np.argsort(seen.t[1])] = np.arange(size) * m // size
    order = np.lexsort((seen.s[1], strip))
    bx, by, other = (v[order] for v in right)
    s, t = seen.s[1][order], seen.t[1][order]
    cuts = np.searchsorted(strip[order], np.arange(m + 1))
    # A strip is cut into cells along the line: held has the cells of the strip before each, twice at its ends.
    s0, n_cells = s[cuts[:-1]].min(), 4 * max(1, size // m)
    per = n_cells / max(float(s.max()) - s0, 1e-9)
    cell = np.minimum(((s - s0) * per).astype(np.int64), n_cells - 1)
    held = np.zeros((m, n_cells + 3), np.int64)
    np.add.at(held, (strip[order], cell + 2), 1)
    np.cumsum(held, axis=1, out=held)
    held += cuts[:-1, None]
    row = np.arange(m)[:, None] * (n_cells + 3)

    def cell_of(along: np.ndarray) -> np.ndarray:
        """Place in ``held`` whose count is of cells before ``along`` for sure; the next one has all that may be."""
        along -= s0
        along *= per
        np.clip(along, -1, n_cells, out=along)
        along += 1
        return along.astype(np.int64) + row

    t0, t1 = np.minimum.reduceat(t, cuts[:-1])[:, None], np.maximum.reduceat(t, cuts[:-1])[:, None]
    near = np.square(np.maximum(np.maximum(t0 - across, across - t1), 0.0))
    wide = np.square(np.maximum(across - t0, t1 - across))
    upto = np.zeros((size + 1, kinds))
    upto[np.arange(1, size + 1), other] = 1
    np.cumsum(upto, axis=0, out=upto)
    each = np.bincount(kind, minlength=kinds).astype(float)
    before = np.outer(each, upto[cuts[:-1]].sum(axis=0))
    place = np.tile(kind.astype(np.int64) * (size + 1), m)
    wide_kind = kind.astype(np.int64) * kinds
    out = np.empty((bands.n + 1, kinds, kinds))
    across_most = 2 * math.sqrt(wide.max())
    low, high = s[cuts[:-1]].min() - along[-1], s.max() - along[0]
    gap, reach = math.sqrt(max(low, 0.0) ** 2 + near.min()), math.sqrt(high * high + wide.max())
    for k in range(bands.n + 1):
        limit = bands.limits[k]
        if limit < gap * (1 - SLACK) or limit > reach * (1 + SLACK):
            out[k] = 0.0 if limit < gap else np.outer(each, upto[-1])
            continue
        square, slack = limit * limit, SLACK * limit
        inner = np.sqrt(np.maximum(square - wide, 0.0))
        inner += along - slack
        outer = np.sqrt(np.maximum(square - near, 0.0))
        outer += along + slack
        sure = held.take(cell_of(inner))
        open_ = held.take(cell_of(outer) + 1)
        if limit < across_most:  # beyond the sides of a strip there is nothing
            sure = np.where(wide <= square, sure, cuts[:-1, None])
            open_ = np.where(near <= square * (1 + SLACK), open_, cuts[:-1, None])
        sure, open_ = sure.ravel(), open_.ravel()
        counted = np.bincount(place + sure, minlength=kinds * (size + 1)).reshape(kinds, size + 1)
        out[k] = counted.astype(float) @ upto - before
        some = np.flatnonzero(open_ > sure)
        counts = open_[some] - sure[some]
        ends = np.cumsum(counts)
        done = 0
        while done < len(some):
            stop = max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + MEASURED, side="right")))
            c, at = counts[done:stop], some[done:stop]
            a = np.repeat(at % len(ax), c)
            b = np.repeat(sure[at] - (np.cumsum(c) - c), c)
            b += np.arange(len(b))
            hit = _squares(ax.take(a) - bx.take(b), ay.take(a) - by.take(b)) <= bands.square[k]
            pair = wide_kind.take(a[hit])
            pair += other.take(b[hit])
            out[k] += np.bincount(pair, minlength=kinds * kinds).reshape(kinds, kinds)
            done = stop
    return np.diff(out, axis=0).astype(np.int64)


def _gap(a0: str, a1: str, b0: str, b1: str) -> tuple[Column, Column]:
    """Smallest and largest distance between two intervals."""
    low = F.greatest(
        F.col(f"l.{a0}") - F.col(f"r.{b1}"), F.col(f"r.{b0}") - F.col(f"l.{a1}"), F.lit(0.0)
    )
    high = F.greatest(F.col(f"l.{a1}") - F.col(f"r.{b0}"), F.col(f"r.{b1}") - F.col(f"l.{a0}"))
    return low, high


def _band_of(distance: Column, bounds: np.ndarray) -> Column:
    """Number of limits below a distance, less one."""
    upto = F.array(*[F.lit(float(v)) for v in bounds])
    return F.size(F.filter(upto, lambda v: v < distance)) - 1


def _tables(by: Sequence[str], n_bands: int, add) -> callable:
    """A task that sums count tables of its slides; ``add(row, table)`` adds one row's pairs."""
    by = list(by)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[tuple, np.ndarray] = {}

        def emit() -> Iterator[pd.DataFrame]:
            for slide, total in totals.items():
                band, a, b = np.nonzero(total)
                out = pd.DataFrame({"band": band, "a": a, "b": b, "n": total[band, a, b]})
                for at, (name, value) in enumerate(zip(by, slide)):
                    out.insert(at, name, pd.Series([value] * len(out), dtype=object))
                yield out
            totals.clear()

        for batch in batches:
            for row in batch.itertuples(index=False):
                slide, k = tuple(row[: len(by)]), int(row.n_types)
                if slide not in totals:
                    if len(totals) == OPEN_SLIDES:
                        yield from emit()
                    totals[slide] = np.zeros((n_bands, k, k), dtype=np.int64)
                add(row, totals[slide])
        yield from emit()

    return count


def pair_counts(
    cells: DataFrame,
    types: Sequence[str] | None,
    limits: Sequence[int],
    tile: float = 128.0,
    block_rows: int = BLOCK_ROWS,
    by: Sequence[str] = (),
) -> DataFrame:
    """(slide, band, type_a, type_b, n): ordered pairs with distance in (limits[k], limits[k+1]].

    Without ``types`` they are those of the cells; a cell whose type a given list lacks
    is an error. Cells without a type do not count. Pairs lie within one slide of ``by``.
    """
    by = list(by)
    bounds = np.asarray(limits, dtype=np.float64)
    typed = cells.filter(F.col("cell_type").isNotNull())
    if types is None:
        listed = typed.agg(F.sort_array(F.collect_set("cell_type"))).scalar()
    else:
        listed = F.array(*[F.lit(t) for t in types])
    place = F.array_position(listed, F.col("cell_type"))
    unknown = F.raise_error(F.concat(F.lit("cell type not listed: "), F.col("cell_type")))
    number = F.when(place > 0, place).otherwise(unknown.cast("long")) - 1
    coded = typed.withColumn("type_code", number.cast("int")).withColumn("n_types", F.size(listed))
    blocks = cut_lineage(_blocks(coded, by, tile, block_rows).withColumn("block", F.monotonically_increasing_id()))
    waves = 16
    blocks = _grouped(blocks, by, waves)
    pairs = _block_pairs(blocks, by, bounds, tile * 2**LEVELS)

    n_bands = len(bounds) - 1
    bands = Bands(bounds)

    def book(row, total: np.ndarray) -> None:
        product = np.outer(row.lhist, row.rhist)
        total[int(row.one_band)] += product + product.T

    def measure(row, total: np.ndarray) -> None:
        kinds = int(row.n_types)
        left = Group(row.lids, row.lsizes, row.lxs, row.lys, row.lts, kinds)
        right = left if row.alone else Group(row.rids, row.rsizes, row.rxs, row.rys, row.rts, kinds)
        for first, second in zip(row.firsts, row.seconds):
            seen = Seen(left.cells[first], right.cells[second])
            if seen.apart():
                hits = _measure_apart(left.cells[first], right.cells[second], seen, bands, kinds)
                total += hits + hits.transpose(0, 2, 1)
                continue
            flat = left.flat(first, right, second)
            hits = _measure(left.nodes(first, flat), right.nodes(second, flat), bands, kinds)
            total += hits if first == second else hits + hits.transpose(0, 2, 1)

    types_of = dict(cells.dtypes)
    schema = ", ".join([*(f"{c} {types_of[c]}" for c in by), "band int", "a int", "b int", "n long"])
    booked = pairs.filter("one_band >= 0").select(*by, "n_types", "one_band", "lhist", "rhist")
    # Pairs count both ways, so either block may come first.
    turned = F.col("lsquare") > F.col("rsquare")
    sides = {"lsquare": "rsquare", "rsquare": "lsquare", "first": "second", "second": "first"}
    open_ = (
        pairs.filter("one_band IS NULL")
        .select(*by, "n_types", *[F.when(turned, F.col(o)).otherwise(F.col(c)).alias(c) for c, o in sides.items()])
        .groupBy(*by, "n_types", "lsquare", "rsquare")
        .agg(F.collect_list("first").alias("firsts"), F.collect_list("second").alias("seconds"))
        .withColumn("alone", F.col("lsquare") == F.col("rsquare"))
    )
    groups = blocks.groupBy("square").agg(
        F.collect_list("block").alias("ids"),
        F.collect_list(F.size("xs")).alias("sizes"),
        *[F.flatten(F.collect_list(c)).alias(c) for c in ("xs", "ys", "ts")],
    )
    held = ("ids", "sizes", "xs", "ys", "ts")
    for side in ("l", "r"):
        cells_of = groups.select(F.col("square").alias(f"{side}square"), *[F.col(c).alias(f"{side}{c}") for c in held])
        open_ = open_.join(cells_of, f"{side}square")
    dealt = spread_by(open_, "lsquare", "rsquare", waves=waves).select(
        *by, "n_types", "alone", "firsts", "seconds", *[f"{side}{c}" for side in ("l", "r") for c in held]
    )
    # Pairs of groups are heavy to measure but small in bytes: they are dealt to many tasks,
    # and to more than cores by far, as those of one group with itself take longer.
    found = booked.mapInPandas(_tables(by, n_bands, book), schema).unionByName(
        dealt.mapInPandas(_tables(by, n_bands, measure), schema)
    )
    return (
        found.groupBy(*by, "band", "a", "b")
        .agg(F.sum("n").alias("n"))
        .select(
            *by,
            "band",
            F.get(listed, F.col("a")).alias("type_a"),
            F.get(listed, F.col("b")).alias("type_b"),
            "n",
        )
    )


def _block_pairs(blocks: DataFrame, by: list[str], bounds: np.ndarray, widest: float) -> DataFrame:
    """Pairs of blocks (first <= second) within reach, with ``one_band`` where a single band holds them whole.

    Blocks meet through buckets as wide as the reach and the largest block together, so
    partners are at most one bucket apart: an equi-join of bounds and counts.
    """
    reach = float(bounds[-1])
    kinds = F.sequence(F.lit(0), F.col("n_types") - 1)
    hist = F.transform(kinds, lambda t: F.size(F.filter("ts", lambda v: v == t)))
    corners = ["x0", "x1", "y0", "y1"]
    wide = reach + widest
    home = blocks.select(
        *by, "block", "square", "n_types", *corners, hist.alias("hist"),
        F.floor(F.col("x0") / wide).alias("gx"), F.floor(F.col("y0") / wide).alias("gy"),
    )
    around = F.array(F.lit(-1), F.lit(0), F.lit(1))
    spread = (
        home.withColumn("_dx", F.explode(around))
        .withColumn("_dy", F.explode(around))
        .withColumn("gx", F.col("gx") + F.col("_dx"))
        .withColumn("gy", F.col("gy") + F.col("_dy"))
    )
    low_x, high_x = _gap("x0", "x1", "x0", "x1")
    low_y, high_y = _gap("y0", "y1", "y0", "y1")
    meet = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in (*by, "gx", "gy")]
    near = F.sqrt(low_x * low_x + low_y * low_y)
    far = F.sqrt(high_x * high_x + high_y * high_y)
    # Bands of the nearest and the farthest pair; -1 within the first limit.
    first, last = _band_of(near, bounds), _band_of(far, bounds)
    whole = (F.col("l.block") != F.col("r.block")) & (near > 0) & (first == last)
    return (
        home.alias("l")
        .join(spread.alias("r"), reduce(and_, meet))
        .filter((F.col("l.block") <= F.col("r.block")) & (low_x * low_x + low_y * low_y <= reach * reach))
        .select(
            *[F.col(f"l.{c}").alias(c) for c in (*by, "n_types")],
            F.col("l.block").alias("first"),
            F.col("r.block").alias("second"),
            F.col("l.square").alias("lsquare"),
            F.col("r.square").alias("rsquare"),
            F.when(whole, first).alias("one_band"),
            F.col("l.hist").alias("lhist"),
            F.col("r.hist").alias("rhist"),
        )
    )


def co_occurrence(counts: DataFrame, limits: Sequence[int], by: Sequence[str] = ()) -> DataFrame:
    """Ratio of P(b | a) to P(b) in every band, for all pairs of types that meet.

    The count table has at most bands x types^2 rows a slide.
    """
    of_band = Window.partitionBy(*by, "band")
    row = F.sum("n").over(Window.partitionBy(*by, "band", "type_a"))
    column = F.sum("n").over(Window.partitionBy(*by, "band", "type_b"))
    total = F.sum("n").over(of_band)
    upper = F.array(*[F.lit(int(v)) for v in list(limits)[1:]])
    return counts.select(
        *by,
        F.get(upper, F.col("band")).alias("distance"),
        "type_a",
        "type_b",
        "n",
        F.try_divide(F.col("n") / row, column / total).alias("ratio"),
    )
