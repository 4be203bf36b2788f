"""Giving every segmented cell a type that agrees with its spot's deconvolution."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ordering import running_sum
from ..session import spread_by
from .merge import NOT_DECONVOLVED
from .summaries import label_entropy

BLOCK_ROWS = 1024


def hash_order(seed: int = 0) -> tuple[Column, Column]:
    """A reproducible shuffle of cells and the coarse ranges of its order."""
    h = F.xxhash64("cell_ids", F.lit(seed))
    return h, F.shiftright(h, 52)


def _slots(counts: DataFrame) -> DataFrame:
    """Per spot an array of (last position, type): the types laid out one after another.

    ``counts`` has one row per (barcode, cell_type), tens per spot.
    """
    upto = F.sum("n").over(Window.partitionBy("barcode").orderBy("cell_type"))
    laid = counts.filter("n > 0").withColumn("upto", upto)
    return laid.groupBy("barcode").agg(
        F.sort_array(F.collect_list(F.struct("upto", "cell_type"))).alias("_slots")
    )


def naive_assignment(
    cells: DataFrame,
    counts: DataFrame,
    order: Column | None = None,
    order_range: Column | None = None,
    seed: int = 0,
) -> DataFrame:
    """Deal the deconvolved types of a spot to its cells in a shuffled order.

    Cells beyond the deconvolved total get no type; cells of a spot without
    deconvolution are 'not deconvolved' in cluster 0. Positions come from running
    sums over ranges of the shuffle key, so a crowded spot is not sorted in one task.
    """
    if order is None:
        order, order_range = hash_order(seed)
    inside = cells.filter(F.col("barcode").isNotNull()).withColumn("_o", order)
    placed = running_sum(
        inside.withColumn("_r", order_range),
        ["barcode"],
        F.col("_r"),
        [F.col("_o"), F.col("cell_ids")],
        F.lit(1),
        "_pos",
    )
    joined = placed.join(_slots(counts), "barcode", "left")
    hit = F.filter("_slots", lambda s: s["upto"] >= F.col("_pos"))
    types = F.array_distinct(F.transform("_slots", lambda s: s["cell_type"]))
    chosen = F.get(hit, F.lit(0))["cell_type"]
    known = F.col("_slots").isNotNull()
    return joined.withColumn("cell_type", F.when(known, chosen).otherwise(NOT_DECONVOLVED)).select(
        *[c for c in cells.columns if c != "cell_type"],
        F.when(known, F.array_position(types, F.col("cell_type")) - 1)
        .otherwise(F.lit(0))
        .cast("int")
        .alias("spot_clusters"),
        "cell_type",
    )


def allocation_score(cells: DataFrame, p_combined: DataFrame) -> DataFrame:
    """Sum of combined probabilities of the current types per spot."""
    return (
        cells.groupBy("barcode", "cluster_name", "cell_type")
        .agg(F.count("*").alias("w"))
        .join(p_combined, ["barcode", "cluster_name", "cell_type"])
        .groupBy("barcode")
        .agg(F.sum(F.col("w") * F.col("p_combined")).alias("score"))
    )


def best_transport(supply: np.ndarray, demand: np.ndarray, gain: np.ndarray) -> np.ndarray:
    """Integer flows of greatest total gain from supplies to demands (equal totals).

    Successive best augmenting paths on a table of clusters x types.
    """
    rows, cols = gain.shape
    flow = np.zeros((rows, cols), dtype=np.int64)
    left, open_ = supply.astype(np.int64).copy(), demand.astype(np.int64).copy()
    while left.sum() > 0:
        row_value = np.where(left > 0, 0.0, -np.inf)
        row_from = np.full(rows, -1)
        col_value = np.full(cols, -np.inf)
        col_from = np.full(cols, -1)
        for _ in range(rows + cols):
            reach = row_value[:, None] + gain
            best = reach.argmax(axis=0)
            value = reach[best, np.arange(cols)]
            better = value > col_value + 1e-12
            if not better.any():
                break
            col_value = np.where(better, value, col_value)
            col_from = np.where(better, best, col_from)
            back = np.where(flow > 0, col_value[None, :] - gain, -np.inf)
            best_col = back.argmax(axis=1)
            value = back[np.arange(rows), best_col]
            better = value > row_value + 1e-12
            row_value = np.where(better, value, row_value)
            row_from = np.where(better, best_col, row_from)
        end = int(np.where(open_ > 0, col_value, -np.inf).argmax())
        path, col, amount = [], end, open_[end]
        while True:
            row = int(col_from[col])
            path.append((row, col, 1))
            if row_from[row] < 0:
                amount = min(amount, left[row])
                break
            col = int(row_from[row])
            path.append((row, col, -1))
            amount = min(amount, flow[row, col])
        for r, c, sign in path:
            flow[r, c] += sign * amount
        left[path[-1][0]] -= amount
        open_[end] -= amount
    return flow


def _tables(known: pd.DataFrame, row: np.ndarray, col: np.ndarray, shape: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Cells and mean probability of every cluster and type of a spot; 0 where there is none."""
    size, at = shape[0] * shape[1], row * shape[1] + col
    flow = np.bincount(at, known["w"].to_numpy(), minlength=size).astype(np.int64)
    p = known["p_combined"].to_numpy(dtype=float)
    there = ~np.isnan(p)
    times = np.bincount(at[there], minlength=size)
    gain = np.bincount(at[there], p[there], minlength=size) / np.maximum(times, 1)
    return flow.reshape(shape), gain.reshape(shape)


def optimal_allocation(cells: DataFrame, p_combined: DataFrame, min_cells: int = 3) -> DataFrame:
    """Reassign the types within each spot for the greatest total probability.

    ``cells`` carries (cell_ids, barcode, cluster_name, cell_type) with the types
    dealt so far. Cells of one morphology cluster are interchangeable, so a spot
    reduces to a table of clusters x types, however many cells it holds; that table
    is solved exactly. Smaller spots than ``min_cells`` keep their types.
    """
    typed = cells.filter(F.col("cell_type").isNotNull() & F.col("barcode").isNotNull())
    table = typed.groupBy("barcode", "cluster_name", "cell_type").agg(F.count("*").alias("w"))
    margin = Window.partitionBy("barcode")
    # Every cluster of a spot meets every type of the spot: clusters x types rows.
    gains = p_combined.join(
        table.select("barcode", "cluster_name", "cell_type", "w"),
        ["barcode", "cluster_name", "cell_type"],
        "left",
    ).na.fill(0, ["w"])
    sized = gains.withColumn("_n", F.sum("w").over(margin)).filter(F.col("_n") >= min_cells)

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        known = pdf.dropna(subset=["cluster_name", "cell_type"])
        clusters, row = np.unique(known["cluster_name"].to_numpy(), return_inverse=True)
        types, col = np.unique(known["cell_type"].to_numpy(), return_inverse=True)
        flow, gain = _tables(known, row, col, (len(clusters), len(types)))
        best = best_transport(flow.sum(axis=1), flow.sum(axis=0), gain)
        row, col = np.nonzero(best)
        return pd.DataFrame(
            {
                "barcode": pdf["barcode"].iloc[0],
                "cluster_name": clusters[row],
                "cell_type": types[col],
                "n": best[row, col],
            }
        )

    kinds = dict(cells.dtypes)
    flows = spread_by(sized, "barcode").groupBy("barcode").applyInPandas(
        solve,
        f"barcode {kinds['barcode']}, cluster_name {kinds['cluster_name']}, cell_type string, n long",
    )
    keys = ["barcode", "cluster_name"]
    upto = F.sum("n").over(Window.partitionBy(*keys).orderBy("cell_type"))
    slots = (
        flows.withColumn("upto", upto)
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list(F.struct("upto", "cell_type"))).alias("_slots"))
    )
    order, order_range = hash_order(1)
    placed = running_sum(
        typed.withColumn("_o", order).withColumn("_r", order_range),
        keys,
        F.col("_r"),
        [F.col("_o"), F.col("cell_ids")],
        F.lit(1),
        "_pos",
    )
    hit = F.get(F.filter("_slots", lambda s: s["upto"] >= F.col("_pos")), F.lit(0))["cell_type"]
    return placed.join(slots, keys, "left").select(
        *[c for c in cells.columns if c != "cell_type"],
        F.coalesce(hit, F.col("cell_type")).alias("cell_type"),
    )


def silhouette(
    cells: DataFrame, key: str = "barcode", label: str = "spot_clusters", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Silhouette of every cell among the cells of its spot; 1 where undefined.

    A spot is cut into blocks of bounded size. Blocks of one spot meet block by
    block; a task sums the distances from each cell to each label of the other
    block, so neither a crowded spot nor its pairs are ever held in one place.
    """
    n = cells.groupBy(key).agg(
        F.ceil(F.count("*") / block_rows).alias("_parts"),
        F.count("*").alias("_n"),
        F.count_distinct(label).alias("_k"),
    )
    blocked = cells.join(n.filter("_k > 1 and _k < _n"), key).withColumn(
        "_part", F.pmod(F.xxhash64("cell_ids"), "_parts")
    )
    blocks = blocked.groupBy(key, "_part").agg(
        F.collect_list("cell_ids").alias("ids"),
        F.collect_list("features").alias("f"),
        F.collect_list(label).alias("l"),
    )
    left = blocks.select(key, *[F.col(c).alias(f"a_{c}") for c in ("ids", "f", "l")])
    right = blocks.select(key, *[F.col(c).alias(f"b_{c}") for c in ("f", "l")])

    def distances(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                a, b = np.stack(row.a_f).astype(float), np.stack(row.b_f).astype(float)
                labels, code = np.unique(np.asarray(row.b_l), return_inverse=True)
                member = np.zeros((len(b), len(labels)))
                member[np.arange(len(b)), code] = 1.0
                total = np.empty((len(a), len(labels)))
                for start in range(0, len(a), 64):
                    gap = a[start : start + 64, None, :] - b[None, :, :]
                    total[start : start + 64] = np.sqrt((gap * gap).sum(axis=2)) @ member
                size = member.sum(axis=0)
                yield pd.DataFrame(
                    {
                        "cell_ids": np.repeat(np.asarray(row.a_ids), len(labels)),
                        "own": np.repeat(np.asarray(row.a_l), len(labels)),
                        "other": np.tile(labels, len(a)),
                        "total": total.ravel(),
                        "size": np.tile(size, len(a)),
                    }
                )

    kinds = dict(cells.dtypes)
    sums = (
        left.join(right, key)
        .select("a_ids", "a_f", "a_l", "b_f", "b_l")
        .mapInPandas(
            distances,
            f"cell_ids {kinds['cell_ids']}, own {kinds[label]}, other {kinds[label]}, "
            "total double, size double",
        )
        .groupBy("cell_ids", "own", "other")
        .agg(F.sum("total").alias("total"), F.sum("size").alias("size"))
    )
    mine = F.col("own") == F.col("other")
    folded = sums.groupBy("cell_ids").agg(
        F.max(F.when(mine, F.try_divide(F.col("total"), F.col("size") - 1))).alias("a"),
        F.max(F.when(mine, F.col("size"))).alias("own_size"),
        F.min(F.when(~mine, F.col("total") / F.col("size"))).alias("b"),
    )
    score = F.when(F.col("own_size") == 1, F.lit(0.0)).otherwise(
        F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0))
    )
    scored = folded.select("cell_ids", score.alias("sil_score"))
    return cells.join(scored, "cell_ids", "left").withColumn(
        "sil_score", F.coalesce("sil_score", F.lit(1.0))
    )


def confidence(cells: DataFrame, label: str = "spot_clusters") -> DataFrame:
    """Silhouette, normalised label entropy of the spot, and sil * (1 - entropy)."""
    scored = silhouette(cells, label=label)
    entropy = label_entropy(cells, "barcode", label).select("barcode", "normalized_entropy")
    return scored.join(entropy, "barcode").withColumn(
        "confidence_score", F.col("sil_score") * (1 - F.col("normalized_entropy"))
    )
