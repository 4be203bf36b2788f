"""Embedding near-duplicates by a forest of random-projection trees with spill.

A tree splits its vectors by a random direction at the median; vectors near the median
go to both sides. Vectors are compared within leaves only, over many trees, so a close
pair that one tree parts meets in another. A node whose vectors point one way is not
split further: a dense group would only lose its own pairs. Large leaves are compared
block against block, so no task holds more than two blocks.

A pair that shares several leaves counts in the first of them, so the number of links
needs no list of pairs: leaves give a count per vector and a spanning forest of edges.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from .components import components
from .rows import ROW, with_row

SAMPLE = 32_768  # vectors that the trees are fitted on, at most
TREES = 8
LEAF = 160  # vectors of the sample below which a node is a leaf
SPILL = 0.01  # half width of the overlap, on projections of unit vectors
DENSE = 0.8  # mean cosine within a node from which it is not split
BLOCK = 1024


class Forest:
    """Trees as flat arrays: direction, threshold, children; leaves are numbered over all trees."""

    def __init__(self, sample: np.ndarray, trees: int = TREES, leaf: int = LEAF, spill: float = SPILL, seed: int = 7):
        self.dims, self.spill = sample.shape[1], spill
        rng = np.random.default_rng(seed)
        self.directions: list[np.ndarray] = []
        self.thresholds: list[float] = []
        self.children: list[tuple[int, int]] = []  # below zero: leaf -1 - number
        self.roots: list[int] = []
        self.leaves = 0
        for _ in range(trees):
            self.roots.append(self._grow(sample, np.arange(len(sample)), leaf, rng))

    def _grow(self, sample: np.ndarray, members: np.ndarray, leaf: int, rng: np.random.Generator) -> int:
        vectors = sample[members]
        if len(members) <= leaf or float(np.square(vectors.mean(axis=0)).sum()) >= DENSE:
            self.leaves += 1
            return -self.leaves
        direction = rng.standard_normal(self.dims)
        direction /= np.linalg.norm(direction)
        at = vectors @ direction
        threshold = float(np.median(at))
        low, high = at <= threshold + self.spill, at > threshold - self.spill
        if low.all() or high.all():  # too narrow for an overlap
            low, high = at <= threshold, at > threshold
        if low.all() or high.all():
            self.leaves += 1
            return -self.leaves
        node = len(self.directions)
        self.directions.append(direction)
        self.thresholds.append(threshold)
        self.children.append((0, 0))
        left = self._grow(sample, members[low], leaf, rng)
        right = self._grow(sample, members[high], leaf, rng)
        self.children[node] = (left, right)
        return node

    def leaves_of(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) memberships of unit vectors, ordered by row."""
        at = np.zeros((len(unit), self.dims))
        width = min(self.dims, unit.shape[1])
        at[:, :width] = unit[:, :width]
        rows, leaves = [], []
        stack = [(root, np.arange(len(unit))) for root in self.roots]
        while stack:
            node, members = stack.pop()
            if not len(members):
                continue
            if node < 0:
                rows.append(members)
                leaves.append(np.full(len(members), -1 - node))
                continue
            p = at[members] @ self.directions[node] - self.thresholds[node]
            left, right = self.children[node]
            stack.append((left, members[p <= self.spill]))
            stack.append((right, members[p > -self.spill]))
        row = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        leaf = np.concatenate(leaves) if leaves else np.zeros(0, np.int64)
        order = np.lexsort((leaf, row))
        return row[order], leaf[order].astype(np.int32)


def prepared(vectors: DataFrame, column: str) -> DataFrame:
    """(_row, key, raw): bytes of each usable vector and a digest of them.

    Left out: null, zero and empty vectors, and those with null or non-finite components.
    """
    single = dict(vectors.dtypes)[column] == "array<float>"
    kind = "<f4" if single else "<f8"
    v = F.col(column)
    usable = (
        v.isNotNull()
        & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists(v, lambda x: x != 0)
    )
    target = pa.large_list(pa.float32() if single else pa.float64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("v").cast(target)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(kind)
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]) * flat.itemsize
            data = flat.tobytes()
            raw = [data[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            key = [hashlib.blake2b(r, digest_size=16).digest() for r in raw]
            yield pa.RecordBatch.from_arrays(
                [batch.column(ROW), pa.array(key, pa.binary()), pa.array(raw, pa.binary())], [ROW, "key", "raw"]
            )

    slim = vectors.filter(usable).select(ROW, (v if single else v.cast("array<double>")).alias("v"))
    return slim.mapInArrow(run, f"{ROW} long, key binary, raw binary")


def unit_rows(raw: list[bytes], kind: str, dims: int) -> np.ndarray:
    m = np.frombuffer(b"".join(raw), dtype=kind).reshape(len(raw), dims).astype(np.float64)
    m = m / np.abs(m).max(axis=1, keepdims=True)  # no overflow in the squares
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def fit(reps: DataFrame, kind: str, sample_rows: int, **settings) -> Forest | None:
    """Trees from the vectors in a share of the hashes, about ``sample_rows`` at most; these reach the driver."""
    part = F.lit(max(1, round((1 << 30) * min(1.0, sample_rows / max(1, reps.count())))))
    taken = reps.filter(F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < part).select("raw", "key").orderBy("key").collect()
    raw = [bytes(r["raw"]) for r in taken]
    if not raw:
        return None
    widths = pd.Series([len(r) for r in raw])
    width = int(widths.mode()[0])
    size = np.dtype(kind).itemsize
    return Forest(unit_rows([r for r in raw if len(r) == width], kind, width // size), **settings)


def _compare(kind: str, threshold: float, model):
    size = np.dtype(kind).itemsize

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        leaf, one, two = key
        out = []
        widths = pdf["raw"].map(len)
        for width in widths.unique():
            part = pdf[widths == width]
            unit = unit_rows(part["raw"].tolist(), kind, width // size)
            side = part["block"].to_numpy()
            a = np.flatnonzero(side == one)
            b = np.flatnonzero(side == two)
            near = unit[a] @ unit[b].T >= threshold
            if one == two:
                near[np.arange(len(a)), np.arange(len(a))] = False
            if not near.any():
                continue
            a, b = a[near.any(axis=1)], b[near.any(axis=0)]
            near = near[near.any(axis=1)][:, near.any(axis=0)]
            # a pair counts in the first leaf that both are in: routed again, which is
            # less than carrying every vector's leaves to each of its leaves
            (ra, la), (rb, lb) = (model.value.leaves_of(unit[rows]) for rows in (a, b))
            (ra, la), (rb, lb) = (ra[la < leaf], la[la < leaf]), (rb[lb < leaf], lb[lb < leaf])
            earlier = np.intersect1d(la, lb)
            if len(earlier):
                ma, mb = np.zeros((len(a), len(earlier)), np.float32), np.zeros((len(b), len(earlier)), np.float32)
                for m, rows, leaves in ((ma, ra, la), (mb, rb, lb)):
                    shared = np.isin(leaves, earlier)
                    m[rows[shared], np.searchsorted(earlier, leaves[shared])] = 1
                near &= (ma @ mb.T) == 0
            if not near.any():
                continue
            ids, w = part[ROW].to_numpy(), part["w"].to_numpy()
            links = np.zeros(len(part), np.int64)
            links[a] += near @ w[b]
            if one != two:
                links[b] += near.T @ w[a]
            for i, j in spanning(near):
                x, y = ids[a[i]], ids[b[j]]
                out.append((int(x), int(y), 0))
            for i in np.flatnonzero(links):
                out.append((int(ids[i]), None, int(links[i])))
        frame = pd.DataFrame(out, columns=["a", "b", "n"])
        return frame.astype({"a": "int64", "b": "Int64", "n": "int64"})

    return run


def spanning(near: np.ndarray) -> Iterator[tuple[int, int]]:
    """Edges of a spanning forest of the bipartite graph rows - columns."""
    left = np.ones(near.shape[0], bool)
    fresh = np.ones(near.shape[1], bool)
    for root in range(near.shape[0]):
        if not left[root]:
            continue
        left[root], queue = False, [root]
        while queue:
            i = queue.pop()
            for j in np.flatnonzero(near[i] & fresh):
                fresh[j] = False
                yield i, int(j)
                for k in np.flatnonzero(near[:, j] & left):
                    left[k] = False
                    yield int(k), int(j)
                    queue.append(int(k))


def near_duplicates(
    vectors: DataFrame,
    column: str = "embedding",
    threshold: float = 0.9,
    sample_rows: int = SAMPLE,
    **settings,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors``.

    Links are pairs of rows with cosine of at least ``threshold`` in double precision,
    found in a common leaf; equal vectors always link. Null, zero, empty vectors and those
    with null or non-finite components link with nothing; vectors of different lengths
    neither. Repeated and null ids are rows of their own; a component's id is its smallest
    vec_id. An empty table gives no rows.
    """
    spark: SparkSession = vectors.sparkSession
    kind = "<f4" if dict(vectors.dtypes)[column] == "array<float>" else "<f8"
    rows = with_row(vectors.select("vec_id", column), "vec_id")
    ready = cut_lineage(prepared(rows, column))
    reps = ready.groupBy("key").agg(F.min(ROW).alias(ROW), F.count("*").alias("w"), F.max("raw").alias("raw"))
    forest = fit(reps, kind, sample_rows, **settings)
    if forest is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    model = spark.sparkContext.broadcast(forest)  # at most 2 x sample rows / leaf nodes a tree
    size = np.dtype(kind).itemsize

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trees = model.value
        for batch in batches:
            widths = batch["raw"].map(len)
            for width in widths.unique():
                part = batch[widths == width].reset_index(drop=True)
                row, leaf = trees.leaves_of(unit_rows(part["raw"].tolist(), kind, width // size))
                cuts = np.searchsorted(row, np.arange(1, len(part)))
                part["leaves"] = np.split(leaf, cuts)
                yield part[[ROW, "w", "raw", "leaves"]]

    routed = reps.select(ROW, "w", "raw").mapInPandas(route, f"{ROW} long, w long, raw binary, leaves array<int>")
    routed = cut_lineage(routed)
    placed = routed.select(F.explode("leaves").alias("leaf"), ROW)
    sizes = placed.groupBy("leaf").agg(F.count("*").alias("k")).filter("k > 1")
    blocks = F.ceil(F.col("k") / BLOCK).cast("int")
    split = (
        routed.withColumn("leaf", F.explode("leaves"))
        .join(sizes, "leaf")
        .withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64(ROW), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "leaf", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"),
            "block", ROW, "w", "raw",
        )
    )
    n = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    found = cut_lineage(
        split.repartition(n, "leaf", "one", "two")
        .groupBy("leaf", "one", "two")
        .applyInPandas(_compare(kind, threshold, model), "a long, b long, n long")
    )
    counts = found.filter("b IS NULL").groupBy(F.col("a").alias(ROW)).agg(F.sum("n").alias("found"))
    edges = found.filter("b IS NOT NULL").select("a", "b")
    roots = components(edges).select(F.col("id").alias(ROW), "root")
    known = (
        reps.select("key", ROW, "w")
        .join(counts, ROW, "left")
        .join(roots, ROW, "left")
        .select("key", (F.coalesce("found", F.lit(0)) + F.col("w") - 1).alias("n_links"), F.coalesce("root", ROW).alias("root"))
    )
    each = ready.select(ROW, "key").join(known, "key").select(ROW, "n_links", "root")
    labelled = rows.select(ROW, "vec_id").join(each, ROW, "left").select(
        "vec_id", ROW, F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("root", ROW).alias("root")
    )
    least = labelled.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    return labelled.join(least, "root").select(
        "vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept")
    )
