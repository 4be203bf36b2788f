"""Vector codes of a byte a part, learned by Lloyd rounds over cover trees.

Vectors become whole numbers and are cut into equal parts. Each block of rows keeps one
cover tree a part: every node has a point of its own as centre, a radius that covers all
points below it, and a range of the points in tree order, so that prefix sums over that
order give the sum of any subtree. A round sends each tree down level by level: where
the nearest codebook entry stays nearest for the whole ball (triangle inequality), the
subtree is assigned at once and its sum read from the prefix sums; only the other nodes
are opened, and small ones are compared point by point. What leaves a block is one sum and
count for each entry, so a round ships codebooks and never vectors.

The trees are written once and serve all rounds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage

PARTS, ENTRIES, ROUNDS = 16, 64, 2
BLOCK_ROWS = 8192  # rows whose trees are built together
LEAF_ROWS = 16  # a node of at most so many points is compared point by point
LARGEST = 1 << 25  # whole numbers are held at this bound, so that squared distances fit a long
HEAVY = 32  # a label with more than one row in so many is heavy
SLACK = 1e-9  # relative room for rounding in the triangle inequality


def distances(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances in whole numbers, points x entries."""
    out = np.zeros((len(points), len(entries)), np.int64)
    for j in range(points.shape[1]):
        step = points[:, j, None] - entries[None, :, j]
        step *= step
        out += step
    return out


class CoverTree:
    """Nodes of a tree over ``points``, level by level; ``order`` lists the points in tree order.

    A node covers order[start:stop]; its children are nodes first:last, none for a leaf.
    Scales at least halve from level to level. A child covers points within the scale of
    its level, the first child keeps the centre of its parent, and the centres of siblings
    are more than that scale apart.
    """

    def __init__(self, order, start, stop, centre, radius, first, last):
        self.order, self.start, self.stop = order, start, stop
        self.centre, self.radius, self.first, self.last = centre, radius, first, last

    @classmethod
    def build(cls, points: np.ndarray, leaf_rows: int = LEAF_ROWS) -> CoverTree:
        n = len(points)
        order = np.arange(n)
        start, stop, centre = [np.array([0])], [np.array([n])], [np.array([0])]
        to_root = np.sqrt(distances(points, points[:1])[:, 0].astype(float))
        radius, first, last = [np.array([to_root.max()])], [], []
        scale = float(to_root.max())
        made = 1  # nodes up to the level at work
        while True:
            lows, highs, mids, rs = start[-1], stop[-1], centre[-1], radius[-1]
            opened = np.flatnonzero((highs - lows > leaf_rows) & (rs > 0))
            if not len(opened):
                first.append(np.zeros(len(lows), np.int64))
                last.append(np.zeros(len(lows), np.int64))
                break
            scale = min(scale, float(rs[opened].max())) / 2
            at = np.concatenate([np.arange(lows[v], highs[v]) for v in opened])  # places in the tree order
            owner = np.repeat(np.arange(len(opened)), (highs - lows)[opened])
            child = np.full(len(at), -1)
            away = np.zeros(len(at))
            centres: list[np.ndarray] = []  # of each wave: a point for every node that is not yet covered
            owners: list[np.ndarray] = []
            left = np.arange(len(at))
            picked, chosen = np.arange(len(opened)), mids[opened]  # the first child keeps the centre
            n_children = 0
            while True:
                rank = np.full(len(opened), -1)
                rank[picked] = np.arange(len(picked))
                mine = rank[owner[left]]
                tried = left[mine >= 0]
                gap = points[order[at[tried]]] - points[chosen[mine[mine >= 0]]]
                gap = np.sqrt((gap * gap).sum(axis=1).astype(float))
                near = gap <= scale
                child[tried[near]] = n_children + mine[mine >= 0][near]
                away[tried[near]] = gap[near]
                centres.append(chosen)
                owners.append(picked)
                n_children += len(picked)
                left = left[child[left] < 0]
                if not len(left):
                    break
                picked, where = np.unique(owner[left], return_index=True)
                chosen = order[at[left[where]]]
            all_owners, all_centres = np.concatenate(owners), np.concatenate(centres)
            place = np.argsort(all_owners, kind="stable")  # children of a node stand together
            number = np.empty(n_children, np.int64)
            number[place] = np.arange(n_children)
            child = number[child]
            sort = np.argsort(child, kind="stable")  # owners ascend with their children
            order[at] = order[at[sort]]
            sizes = np.bincount(child, minlength=n_children)
            far = np.zeros(n_children)
            np.maximum.at(far, child, away)
            before = np.cumsum(sizes) - sizes
            begins = at[before]  # ranges of opened nodes keep their places
            start.append(begins)
            stop.append(begins + sizes)
            centre.append(all_centres[place])
            radius.append(far)
            per_node = np.bincount(all_owners, minlength=len(opened))
            begin, end = np.zeros(len(lows), np.int64), np.zeros(len(lows), np.int64)
            base = made + np.cumsum(per_node) - per_node
            begin[opened], end[opened] = base, base + per_node
            first.append(begin)
            last.append(end)
            made += n_children
        return cls(order, *(np.concatenate(x) for x in (start, stop, centre, radius, first, last)))

    def assign(self, points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """(codes, sum of each entry, count of each entry, points compared one by one).

        Ties go to the lower entry: a subtree is assigned whole only where no tie can be.
        """
        sums = np.zeros((len(points) + 1, points.shape[1]), np.int64)  # prefix sums in tree order
        np.cumsum(points[self.order], axis=0, out=sums[1:])
        codes = np.zeros(len(points), np.int64)
        total = np.zeros((len(entries), points.shape[1]), np.int64)
        count = np.zeros(len(entries), np.int64)
        compared = 0
        nodes = np.array([0])
        while len(nodes):
            square = distances(points[self.centre[nodes]], entries)
            best = square.argmin(axis=1)
            root = np.sqrt(square.astype(float))
            here = root[np.arange(len(nodes)), best]
            root[np.arange(len(nodes)), best] = np.inf
            second = root.min(axis=1)
            radius = self.radius[nodes]
            clear = second - here > 2 * radius + SLACK * (np.where(np.isinf(second), 0, second) + here + radius + 1)
            clear |= radius == 0  # copies of the centre
            done = nodes[clear]
            low, high, code = self.start[done], self.stop[done], best[clear]
            np.add.at(total, code, sums[high] - sums[low])
            np.add.at(count, code, high - low)
            if len(done):
                codes[self.order[_ranges(low, high)]] = np.repeat(code, high - low)
            open_ = nodes[~clear]
            leaves = open_[self.last[open_] == self.first[open_]]
            if len(leaves):
                at = self.order[_ranges(self.start[leaves], self.stop[leaves])]
                exact = distances(points[at], entries).argmin(axis=1)
                compared += len(at)
                codes[at] = exact
                np.add.at(total, exact, points[at])
                np.add.at(count, exact, 1)
            inner = open_[self.last[open_] > self.first[open_]]
            nodes = _ranges(self.first[inner], self.last[inner])
        return codes, total, count, compared


def _ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """low[0]..high[0]-1, low[1]..high[1]-1, ... in one array."""
    size = high - low
    if not len(size) or not size.sum():
        return np.zeros(0, np.int64)
    return np.arange(size.sum()) + np.repeat(low - (np.cumsum(size) - size), size)


def usable(vector: Column) -> Column:
    """Neither null nor with null or non-finite components."""
    x = F.transform(vector, lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad, F.lit(False))


def whole_numbers(vector: Column) -> Column:
    """floor(256 x) of every component, held at LARGEST."""
    bound = float(LARGEST)
    return F.transform(
        vector, lambda v: F.floor(F.least(F.greatest(v.cast("double") * 256, F.lit(-bound)), F.lit(bound))).cast("int")
    )


def _padded(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.diff(column.offsets.to_numpy()).astype(np.int64)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), _ranges(np.zeros_like(sizes), sizes)] = flat
    return out


NODES = ("order", "start", "stop", "centre", "radius", "first", "last")
STORED = "part int, n int, points binary, " + ", ".join(f"{name} binary" for name in NODES) + ", kept binary"


def _blocks(vectors: DataFrame, width: int, parts: int, block_rows: int, leaf_rows: int) -> DataFrame:
    """One row for each part of each block of rows: its points and its tree, as bytes.

    The last column of ``vectors`` is the vector; the others are kept with the first part.
    """

    def trees(rows: pa.Table) -> pa.RecordBatch:
        whole = _padded(rows.column("v"), width).reshape(len(rows), parts, width // parts)
        sink = pa.BufferOutputStream()
        kept = rows.drop_columns(["v"]).combine_chunks()
        with pa.ipc.new_stream(sink, kept.schema) as writer:
            writer.write_table(kept)
        out = []
        for part in range(parts):
            points = np.ascontiguousarray(whole[:, part])
            tree = CoverTree.build(points, leaf_rows)
            arrays = {x: getattr(tree, x).astype(np.float64 if x == "radius" else np.int32).tobytes() for x in NODES}
            kept_bytes = sink.getvalue().to_pybytes() if part == 0 else b""
            out.append({"part": part, "n": len(rows), "points": points.astype(np.int32).tobytes()} | arrays | {"kept": kept_bytes})
        schema = [("part", pa.int32()), ("n", pa.int32()), *((x, pa.binary()) for x in ("points", *NODES, "kept"))]
        return pa.RecordBatch.from_pylist(out, pa.schema(schema))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            while batch.num_rows:
                room = block_rows - sum(b.num_rows for b in held)
                held.append(batch.slice(0, room))
                batch = batch.slice(room)
                if sum(b.num_rows for b in held) == block_rows:
                    yield trees(pa.Table.from_batches(held))
                    held = []
        if held:
            yield trees(pa.Table.from_batches(held))

    return vectors.mapInArrow(build, STORED)


def _read(row: dict, dims: int) -> tuple[np.ndarray, CoverTree]:
    """(points, tree) of one stored row."""
    points = np.frombuffer(row["points"], np.int32).astype(np.int64).reshape(row["n"], dims)
    arrays = [np.frombuffer(row[x], np.float64) if x == "radius" else np.frombuffer(row[x], np.int32).astype(np.int64) for x in NODES]
    return points, CoverTree(*arrays)


def codebooks(blocks: DataFrame, start: np.ndarray, rounds: int) -> np.ndarray:
    """Codebooks (part, entry, component) after ``rounds`` of Lloyd's method from ``start``.

    An entry becomes the floored mean of its points; one without points stays.
    """
    books = start
    parts, entries, dims = books.shape
    sums = [f"s{j}" for j in range(dims)]
    for _ in range(rounds):
        found = (
            blocks.mapInArrow(_totals(books), "part int, entry int, count long, " + ", ".join(f"{s} long" for s in sums))
            .groupBy("part", "entry")
            .agg(F.sum("count").alias("count"), *[F.sum(s).alias(s) for s in sums])
            .toPandas()  # at most parts x entries rows
        )
        books = books.copy()
        mean = found[sums].to_numpy(np.int64) // found[["count"]].to_numpy(np.int64)
        books[found["part"].to_numpy(np.int64), found["entry"].to_numpy(np.int64)] = mean
    return books


def _totals(books: np.ndarray):
    """Sum and count of every entry over the blocks of a task; the codebooks travel with it."""
    parts, entries, dims = books.shape

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, dims), np.int64)
        count = np.zeros((parts, entries), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                points, tree = _read(row, dims)
                _, s, c, _ = tree.assign(points, books[row["part"]])
                total[row["part"]] += s
                count[row["part"]] += c
        part, entry = np.nonzero(count)
        columns = [part.astype(np.int32), entry.astype(np.int32), count[part, entry], *total[part, entry].T]
        names = ["part", "entry", "count", *(f"s{j}" for j in range(dims))]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    return totals


def _encoded(blocks: DataFrame, books: np.ndarray, schema: T.StructType) -> DataFrame:
    """The kept columns of every row with its code and squared error."""
    parts, _, dims = books.shape

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = codes = errors = None
        for batch in batches:
            for row in batch.to_pylist():  # the parts of a block follow one another
                part = row["part"]
                if part == 0:
                    rows = pa.ipc.open_stream(row["kept"]).read_all().combine_chunks()
                    codes = np.zeros((row["n"], parts), np.uint8)
                    errors = np.zeros(row["n"], np.int64)
                points, tree = _read(row, dims)
                found = tree.assign(points, books[part])[0]
                codes[:, part] = found
                step = points - books[part][found]
                errors += (step * step).sum(axis=1)
                if part == parts - 1:
                    text = codes.tobytes().hex()
                    wide = 2 * parts
                    shown = [text[i : i + wide] for i in range(0, len(text), wide)]
                    out = rows.append_column("code", pa.array(shown, pa.string())).append_column("error", pa.array(errors))
                    yield from out.to_batches()

    return blocks.mapInArrow(code, schema)


def encode(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    keep: Sequence[str] = (),
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    block_rows: int = BLOCK_ROWS,
    leaf_rows: int = LEAF_ROWS,
) -> tuple[DataFrame, np.ndarray]:
    """((id, columns ``keep``, code, error) of every usable row, final codebooks).

    ``code`` has two hex digits a part, ``error`` is the squared distance to the entries;
    codebooks are (part, entry, component). They start from the rows with the smallest ids
    (null ids last, equal ids by their vectors); with fewer rows there are fewer entries.

    Rows with a null vector or with null or non-finite components are left out. Shorter
    vectors count as filled up with zeros to the longest one, and that to a multiple of
    ``parts``, which leaves distances as they are. Components beyond 2^17 are held at that
    bound. Repeated rows are coded alike; columns not named in ``keep`` are ignored; an
    empty table gives no rows and empty codebooks.
    """
    if not 1 <= entries <= 256:
        raise ValueError("the number of an entry is a byte: 1 to 256 entries")
    kept = vectors.filter(usable(F.col(vector_col)))
    kept = kept.select(F.col(id_col), *keep, whole_numbers(F.col(vector_col)).alias("v"))
    longest = kept.agg(F.max(F.size("v")).alias("n")).first()["n"] or 0
    width = max(1, -(-longest // parts)) * parts
    dims = width // parts
    first = kept.select(F.col(id_col).alias("i"), "v").orderBy(F.col("i").asc_nulls_last(), "v").limit(entries).collect()
    start = np.zeros((len(first), width), np.int64)
    for i, row in enumerate(first):
        start[i, : len(row["v"])] = row["v"]
    start = np.ascontiguousarray(start.reshape(len(first), parts, dims).transpose(1, 0, 2))
    fields = [f for f in kept.schema.fields if f.name != "v"]
    schema = T.StructType([*fields, T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    if not first:
        return vectors.sparkSession.createDataFrame([], schema), start
    blocks = cut_lineage(_blocks(kept, width, parts, block_rows, leaf_rows))
    books = codebooks(blocks, start, rounds)
    return _encoded(blocks, books, schema), books


def codebooks_digest(books: np.ndarray) -> str:
    """sha256 of all whole numbers of the codebooks, comma-joined."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def decode(encoded: DataFrame, books: np.ndarray, out: str = "decoded") -> DataFrame:
    """Add the vector that a code stands for, in whole numbers; a null code gives null."""
    parts, entries, dims = books.shape
    flat = [F.array(*[F.lit(int(x)) for x in row]) for row in books.reshape(parts, entries * dims)]

    def piece(part: int) -> Column:
        code = F.conv(F.substring("code", 2 * part + 1, 2), 16, 10).cast("int")
        return F.slice(flat[part], code * dims + 1, dims)

    return encoded.withColumn(out, F.when(F.col("code").isNotNull(), F.concat(*[piece(p) for p in range(parts)])))


def total_by_label(rows: DataFrame, label: str, value: str, out: str) -> DataFrame:
    """Add ``out`` = sum of ``value`` over rows with an equal label, nulls together.

    A label with more than one row in HEAVY is joined by broadcast: there are fewer than
    HEAVY of these. The rows of such labels stay out of the shuffled join.
    """
    named = rows.withColumn("_l", F.struct(F.col(label).alias("l")))
    totals = cut_lineage(named.groupBy("_l").agg(F.sum(value).alias(out), F.count("*").alias("_n")))
    n = totals.agg(F.sum("_n").alias("n")).first()["n"] or 0
    heavy = totals.filter(F.col("_n") * HEAVY > n).select("_l", F.col(out).alias("_heavy"))
    light = totals.filter(F.col("_n") * HEAVY <= n).select("_l", F.lit(-1).alias("_spread"), F.col(out).alias("_light"))
    spread = F.when(F.col("_heavy").isNull(), F.lit(-1)).otherwise(F.pmod(F.monotonically_increasing_id(), F.lit(4096)).cast("int"))
    joined = named.join(F.broadcast(heavy), "_l", "left").withColumn("_spread", spread).join(light, ["_l", "_spread"], "left")
    return joined.withColumn(out, F.coalesce("_heavy", "_light")).drop("_l", "_heavy", "_light", "_spread")
