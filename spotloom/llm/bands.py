"""From band hashes to verified links, whatever the size of a bucket.

Candidates are taken as stars, not as pairs of a bucket: each task links the members of
a bucket to the least of them, and only that one leaves the task, so a group of near
copies is folded before the shuffle. Members whose sizes rule a similarity out are kept apart. Verified links give components. Buckets whose
members are still in different components are compared in full: they are joined into
clusters, a cluster is cut into blocks, and each pair of blocks is compared in one task,
which gives a link for each two components that it finds to touch. No connection between
items that share a bucket is lost; pairs inside a component are not needed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .components import components
from .shingles import mix

BLOCK = 512  # items of a cluster compared with as many others in one task
COLUMNS = 4096  # shingles counted at once
LARGE = (1 << 16) - 1  # sizes of items are held here
SLOTS = 16  # of buckets, in each shuffle partition
ENTRIES = 1 << 19  # of buckets that a task folds before it sends them

Weights = tuple[np.ndarray, np.ndarray]  # distinct shingle hashes in order, and weights
# Texts, as stored, to (hash, number of the text, weight), ordered by number, then hash.
Shingler = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray, np.ndarray]]


def band_hashes(signatures: np.ndarray, rows: int) -> np.ndarray:
    """(item, band) hashes of ``rows`` registers each; the band's number is part of the hash."""
    n, m = signatures.shape
    grid = signatures.reshape(n, m // rows, rows)
    h = np.arange(m // rows, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15)
    for i in range(rows):
        h = mix(h ^ mix(grid[:, :, i]))
    return h.view(np.int64)


def _packed(slots: np.ndarray, *columns: np.ndarray) -> dict[int, bytes]:
    """Entries by slot: the bytes of each column in turn."""
    order = np.argsort(slots, kind="stable")
    slots, columns = slots[order], [c[order] for c in columns]
    at = np.flatnonzero(np.concatenate([[True], slots[1:] != slots[:-1]])) if len(slots) else []
    ends = [*at[1:], len(slots)]
    return {int(slots[i]): b"".join(c[i:j].tobytes() for c in columns) for i, j in zip(at, ends, strict=False)}


def _unpacked(parts: list[bytes], *kinds: type) -> list[np.ndarray]:
    """The columns of entries that ``_packed`` gave, of all parts one after the other."""
    size = sum(np.dtype(k).itemsize for k in kinds)
    out, starts = [], [0] * len(parts)
    for kind in kinds:
        counts = [len(p) // size for p in parts]
        read = [np.frombuffer(p, kind, n, s) for p, n, s in zip(parts, counts, starts, strict=True)]
        out.append(np.concatenate(read) if read else np.zeros(0, kind))
        starts = [s + n * np.dtype(kind).itemsize for s, n in zip(starts, counts, strict=True)]
    return out


def _led(
    bucket: np.ndarray, ids: np.ndarray, low: np.ndarray, high: np.ndarray, similarity: float
) -> tuple[np.ndarray, ...]:
    """(bucket, least id, least size, largest size) of each group and the distinct pairs (least id, other id).

    A group holds the entries of a bucket whose sizes follow each other without a gap that
    no two similar items can span.
    """
    order = np.lexsort((low, bucket))
    bucket, ids, low, high = bucket[order], ids[order], low[order], high[order]
    new = np.concatenate([[True], bucket[1:] != bucket[:-1]])
    top = np.maximum.accumulate((np.cumsum(new) << 16) + high) & 0xFFFF  # within the bucket
    new[1:] |= top[:-1] < similarity * low[1:] - 1e-6
    heads = np.flatnonzero(new)
    lead = np.minimum.reduceat(ids, heads)
    each = lead[np.cumsum(new) - 1]
    held = ids != each
    a, b = each[held], ids[held]
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    fresh = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])[: len(a)]  # once for all its buckets
    return bucket[heads], lead, low[heads], np.maximum.reduceat(high, heads), a[fresh], b[fresh]


def _stars(items: DataFrame, similarity: float) -> DataFrame:
    """(a, b): members of a group with the least of them, a < b.

    Groups are those of buckets by size: with a gap in the sizes, no item before it can be
    similar to one after it. A bucket is dealt to a slot by the upper half of its hash and known there by
    the lower half, which is sent; should two buckets of a slot agree in it, their members
    are candidates too. The entries of a slot leave a task as one row.
    """
    n = int(items.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    slots = np.uint64(SLOTS * n)

    def folded(buckets: list[np.ndarray], members: list[np.ndarray], sizes: list[np.ndarray]) -> pa.RecordBatch:
        size = np.concatenate(sizes)
        bucket, lead, low, high, a, b = _led(np.concatenate(buckets), np.concatenate(members), size, size, similarity)
        h = bucket.view(np.uint64)
        alone = _packed(
            ((h >> np.uint64(32)) % slots).astype(np.int64), h.astype(np.uint32), lead,
            *[x.astype(np.uint8) for x in (low, low >> 8, high - low, (high - low) >> 8)],  # mostly zeros, apart
        )
        pairs = _packed((mix(a.view(np.uint64) ^ (b.view(np.uint64) << np.uint64(1))) % slots).astype(np.int64), a, b)
        each = sorted(alone.keys() | pairs.keys())
        return pa.RecordBatch.from_arrays(
            [
                pa.array(each, pa.int64()),
                pa.array([alone.get(s, b"") for s in each], pa.binary()),
                pa.array([pairs.get(s, b"") for s in each], pa.binary()),
            ],
            ["slot", "alone", "pairs"],
        )

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = [[], [], []]
        for batch in batches:
            lists = batch.column("bands")
            counts, flat = lists.value_lengths().to_numpy(), lists.flatten().to_numpy()
            if not len(flat):
                continue
            held[0].append(flat)
            held[1].append(np.repeat(batch.column("id").to_numpy(), counts))
            held[2].append(np.repeat(batch.column("size").to_numpy(), counts))
            if sum(map(len, held[0])) >= ENTRIES:
                yield folded(*held)
                held = [[], [], []]
        if held[0]:
            yield folded(*held)

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solved(alone: list[bytes], pairs: list[bytes]) -> Iterator[pa.RecordBatch]:
            bucket, ids, low, low8, more, more8 = _unpacked(alone, np.uint32, np.int64, *[np.uint8] * 4)
            a, b = _unpacked(pairs, np.int64, np.int64)
            if len(bucket):
                low = low.astype(np.int64) + (low8.astype(np.int64) << 8)
                high = low + more + (more8.astype(np.int64) << 8)
                *_, more_a, more_b = _led(bucket, ids, low, high, similarity)
                a, b = np.concatenate([a, more_a]), np.concatenate([b, more_b])
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        last, alone, pairs = None, [], []
        for batch in batches:
            for slot, x, y in zip(*(batch.column(c).to_pylist() for c in ("slot", "alone", "pairs")), strict=True):
                if slot != last and last is not None:
                    yield from solved(alone, pairs)
                    alone, pairs = [], []
                last = slot
                alone.append(x)
                pairs.append(y)
        yield from solved(alone, pairs)

    rows = items.select("id", "size", "bands").mapInArrow(local, "slot long, alone binary, pairs binary")
    ordered = rows.repartition(n, "slot").sortWithinPartitions("slot")
    return ordered.mapInArrow(across, "a long, b long").distinct()


def probability_jaccard(x: Weights, y: Weights) -> float:
    """sum over shared i of 1 / sum over j of max(x_j / x_i, y_j / y_i).

    With all weights equal it is the Jaccard similarity of the two sets.
    """
    if not len(x[0]) or not len(y[0]):
        return 0.0
    _, i, j = np.intersect1d(x[0], y[0], assume_unique=True, return_indices=True)
    if not len(i):
        return 0.0
    a, b = x[1][i].astype(float), y[1][j].astype(float)
    ratio = a / b
    order = np.argsort(ratio, kind="stable")
    a, b, ratio = a[order], b[order], ratio[order]
    at = np.searchsorted(ratio, ratio, side="left")  # shared j with a smaller ratio
    below = np.concatenate([[0.0], np.cumsum(b)])[at]
    above = a.sum() - np.concatenate([[0.0], np.cumsum(a)])[at]
    only_x, only_y = x[1].sum() - a.sum(), y[1].sum() - b.sum()
    return float((1.0 / ((above + only_x) / a + (below + only_y) / b)).sum())


def similarities(one: tuple[np.ndarray, ...], two: tuple[np.ndarray, ...], n: int) -> np.ndarray:
    """Similarity of the texts of equal number in two outputs of a shingler."""
    if n <= 4096:  # owner and 52 bits of the hash in one key; either side is in order
        key = np.concatenate([(side[1].astype(np.uint64) << np.uint64(52)) | (side[0] >> np.uint64(12)) for side in (one, two)])
        key.sort(kind="stable")
        twice = key[1:][key[1:] == key[:-1]] >> np.uint64(52)
    else:
        h, owner = np.concatenate([one[0], two[0]]), np.concatenate([one[1], two[1]])
        order = np.lexsort((h, owner))
        h, owner = h[order], owner[order]
        twice = owner[1:][(h[1:] == h[:-1]) & (owner[1:] == owner[:-1])]
    both = np.bincount(twice.astype(np.int64), minlength=n)
    edges = [np.searchsorted(side[1], np.arange(n + 1)) for side in (one, two)]
    sizes = sum(np.diff(e) for e in edges)
    out = both / np.maximum(1, sizes - both)
    heavy = np.zeros(n, bool)
    for side in (one, two):
        heavy[side[1][side[2] > 1]] = True
    for i in np.flatnonzero(heavy & (both > 0)):
        x, y = (slice(*e[i : i + 2]) for e in edges)
        out[i] = probability_jaccard((one[0][x], one[2][x]), (two[0][y], two[2][y]))
    return out


def _verified(pairs: DataFrame, shingle: Shingler, similarity: float) -> DataFrame:
    """Rows of (a, b, za, zb) whose similarity is at least ``similarity``, as (a, b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                one, two = (shingle(part.column(c).to_pylist()) for c in ("za", "zb"))
                keep = pa.array(similarities(one, two, part.num_rows) >= similarity)
                yield part.select(["a", "b"]).filter(keep)

    return pairs.mapInArrow(run, "a long, b long")


def _bounds(one: list[Weights], two: list[Weights]) -> np.ndarray:
    """Upper bounds of the similarity of each two items: the share of weight that they may have in common."""
    shared = np.intersect1d(np.concatenate([w[0] for w in one]), np.concatenate([w[0] for w in two]))
    by_one = np.zeros((len(one), len(two)))
    by_two = np.zeros((len(one), len(two)))

    def matrix(items: list[Weights], low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        columns = shared[low:high]
        weights, there = np.zeros((len(items), len(columns)), np.float32), np.zeros((len(items), len(columns)), np.float32)
        for row, (h, w) in enumerate(items):
            at = np.searchsorted(columns, h)
            hit = at < len(columns)
            hit[hit] = columns[at[hit]] == h[hit]
            weights[row, at[hit]], there[row, at[hit]] = w[hit], 1
        return weights, there

    for low in range(0, len(shared), COLUMNS):
        w1, t1 = matrix(one, low, low + COLUMNS)
        w2, t2 = matrix(two, low, low + COLUMNS)
        by_one += w1 @ t2.T
        by_two += t1 @ w2.T
    total1 = np.array([max(1, w.sum()) for _, w in one])
    total2 = np.array([max(1, w.sum()) for _, w in two])
    return np.minimum(by_one / total1[:, None], by_two / total2[None, :])


def _touching(
    known: list[Weights], ids: np.ndarray, comp: np.ndarray, one: np.ndarray, two: np.ndarray, same: bool, similarity: float
) -> list[tuple[int, int]]:
    """A link for each two components that touch, among the rows ``one`` and ``two`` of a block pair."""
    apart = comp[one][:, None] != comp[two][None, :]
    if same:
        apart &= np.arange(len(one))[:, None] < np.arange(len(two))[None, :]
    if apart.sum() > 30:
        apart &= _bounds([known[i] for i in one], [known[j] for j in two]) >= similarity - 1e-6
    root: dict[int, int] = {}

    def find(c: int) -> int:
        while root.setdefault(c, c) != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    out = []
    for i, j in np.argwhere(apart):
        i, j = one[i], two[j]
        ri, rj = find(int(comp[i])), find(int(comp[j]))
        if ri != rj and probability_jaccard(known[i], known[j]) >= similarity:
            root[max(ri, rj)] = min(ri, rj)
            out.append((min(int(ids[i]), int(ids[j])), max(int(ids[i]), int(ids[j]))))
    return out


def _compared(blocks: DataFrame, shingle: Shingler, similarity: float) -> DataFrame:
    """Links (a, b) found in each pair of blocks (cluster, one, two)."""

    def solve(rows: pd.DataFrame) -> list[tuple[int, int]]:
        if not len(rows):
            return []
        keys = rows[["cluster", "one", "two"]].to_numpy()
        cuts = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, [len(keys)]])
        side, ids, comp, z = (rows[c].to_numpy() for c in ("block", "id", "comp", "z"))
        out: list[tuple[int, int]] = []
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if b - a < 2 or (comp[a:b] == comp[a]).all():
                continue
            h, owner, weight = shingle(z[a:b].tolist())
            edges = np.searchsorted(owner, np.arange(b - a + 1))
            known = [(h[i:j], weight[i:j]) for i, j in zip(edges[:-1], edges[1:], strict=True)]
            one, two = np.flatnonzero(side[a:b] == keys[a, 1]), np.flatnonzero(side[a:b] == keys[a, 2])
            out += _touching(known, ids[a:b], comp[a:b], one, two, keys[a, 1] == keys[a, 2], similarity)
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            if not len(batch):
                continue
            batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            keys = batch[["cluster", "one", "two"]].to_numpy()
            cut = int(np.argmax((keys == keys[-1]).all(axis=1)))  # the last group may go on
            yield pd.DataFrame(solve(batch.iloc[:cut]), columns=["a", "b"]).astype("int64")
            rest = batch.iloc[cut:].reset_index(drop=True)
        if rest is not None:
            yield pd.DataFrame(solve(rest), columns=["a", "b"]).astype("int64")

    n = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    ordered = blocks.repartition(n, "cluster", "one", "two").sortWithinPartitions("cluster", "one", "two")
    return ordered.mapInPandas(run, "a long, b long")


def linked(
    items: DataFrame,
    texts: Callable[[DataFrame], DataFrame],
    shingle: Shingler,
    similarity: float,
    again: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """(id, root) of the items that link with others; root is the smallest id of the component.

    ``items`` has id and bands (array of long), an id perhaps more than once with the same
    bands; ``texts(ids)`` gives (id, z) of the ids,
    z being the text in a form that ``shingle`` reads. ``again`` gives the same columns from
    (id, z), where that is cheaper than sending those of all items to the ids asked for.
    Where weights are all one, ``items`` may have size, the number of shingles (an int, at
    most LARGE): items of the share ``similarity`` differ in it by that factor at most, so
    a bucket falls into groups.
    """
    if "size" not in items.columns:
        items = items.withColumn("size", F.lit(1))
    pairs = cut_lineage(_stars(items, similarity))
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    content = cut_lineage(texts(ids))
    with_a = pairs.join(content.select(F.col("id").alias("a"), F.col("z").alias("za")), "a")
    with_b = with_a.join(content.select(F.col("id").alias("b"), F.col("z").alias("zb")), "b")
    links = cut_lineage(_verified(with_b.select("a", "b", "za", "zb"), shingle, similarity))
    roots = components(links)

    if again:
        mine = again(content)
    else:
        mine = items.join(content.select("id"), "id", "left_semi").groupBy("id").agg(
            F.first("bands").alias("bands"), F.first("size").alias("size")
        )
    members = mine.join(roots, "id", "left").select(
        F.explode("bands").alias("bucket"), "id", F.coalesce("root", "id").alias("comp"), "size"
    )
    sized = Window.partitionBy("bucket").orderBy("size")
    gap = F.lag("size").over(sized) < similarity * F.col("size") - 1e-6
    group = F.count_if("gap").over(sized.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    whole = Window.partitionBy("bucket", "group")
    rest = (  # the two of a group of two have been compared
        members.withColumn("gap", gap)
        .withColumn("group", group)
        .withColumns({"low": F.min("comp").over(whole), "high": F.max("comp").over(whole), "k": F.count("*").over(whole)})
        .filter("low < high AND k > 2")
        .groupBy("id", "comp")
        .agg(F.collect_set("low").alias("lows"))  # one for each of the item's buckets at most
    )
    rest = cut_lineage(rest)
    if not rest.take(1):
        return roots
    touching = rest.select(F.explode("lows").alias("a"), F.col("comp").alias("b")).distinct()
    clusters = components(touching).select(F.col("id").alias("comp"), F.col("root").alias("cluster"))
    placed = rest.select("id", "comp").join(clusters, "comp")
    sizes = placed.groupBy("cluster").agg(F.count("*").alias("k"))
    blocks = (
        placed.join(sizes, "cluster")
        .withColumn("blocks", F.ceil(F.col("k") / BLOCK).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        .join(content, "id")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "cluster", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"),
            "block", "id", "comp", "z",
        )
    )
    more = cut_lineage(_compared(blocks, shingle, similarity))
    if not more.take(1):
        return roots
    return components(links.unionByName(more))
