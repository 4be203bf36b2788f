"""Segmentation and classification quality."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import ratio
from ..session import spread_by
from .components import contract_labels


def overlaps(masks: DataFrame) -> DataFrame:
    """(img, true_id, pred_id, inter, t_area, p_area, iou) of instances that meet.

    One fold of the pixels gives all three areas: counts per (true, predicted) pair
    keep the background as id 0, and the areas are sums of those counts.
    """
    cells = masks.groupBy("img", "true_id", "pred_id").agg(F.count("*").alias("inter"))
    true_area = cells.groupBy("img", "true_id").agg(F.sum("inter").alias("t_area"))
    pred_area = cells.groupBy("img", "pred_id").agg(F.sum("inter").alias("p_area"))
    met = cells.filter("true_id > 0 and pred_id > 0")
    return (
        met.join(true_area, ["img", "true_id"])
        .join(pred_area, ["img", "pred_id"])
        .withColumn(
            "iou", ratio(F.col("inter"), F.col("t_area") + F.col("p_area") - F.col("inter"))
        )
    )


def binary_dice(masks: DataFrame) -> DataFrame:
    t, p = F.col("true_id") > 0, F.col("pred_id") > 0
    return masks.groupBy("img").agg(
        ratio(2 * F.count_if(t & p), F.count_if(t) + F.count_if(p)).alias("dice")
    )


def ensemble_dice(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("img").agg(
        ratio(2 * F.sum("inter"), F.sum(F.col("t_area") + F.col("p_area"))).alias("dice2")
    )


def _areas(masks: DataFrame, column: str, name: str) -> DataFrame:
    return (
        masks.filter(F.col(column) > 0)
        .groupBy("img", column)
        .agg(F.count("*").alias(name))
    )


def jaccard_index(masks: DataFrame, pairs: DataFrame) -> DataFrame:
    """Aggregated Jaccard: each true instance with its best prediction, the rest in the union."""
    score = F.col("inter") / (F.col("t_area") + F.col("p_area") - F.col("inter") + 1e-6)
    best = pairs.withColumn("s", score).groupBy("img", "true_id").agg(
        F.max_by(F.struct("pred_id", "inter", "t_area", "p_area"), F.struct("s", -F.col("pred_id"))).alias("m")
    ).select("img", "true_id", "m.*")
    return _jaccard(masks, best)


def _jaccard(masks: DataFrame, chosen: DataFrame) -> DataFrame:
    """Overlap over union of chosen pairs, unpaired instances adding to the union."""
    inter = chosen.groupBy("img").agg(
        F.sum("inter").alias("i"),
        F.sum(F.col("t_area") + F.col("p_area") - F.col("inter")).alias("u"),
    )
    lone_true = _areas(masks, "true_id", "a").join(chosen, ["img", "true_id"], "left_anti")
    lone_pred = _areas(masks, "pred_id", "a").join(chosen, ["img", "pred_id"], "left_anti")
    lone = lone_true.select("img", "a").unionByName(lone_pred.select("img", "a"))
    extra = lone.groupBy("img").agg(F.sum("a").alias("e"))
    return inter.join(extra, "img", "full").select(
        "img",
        F.coalesce(
            ratio(F.col("i"), F.coalesce("u", F.lit(0)) + F.coalesce("e", F.lit(0))), F.lit(0.0)
        ).alias("aji"),
    )


def panoptic_quality(masks: DataFrame, pairs: DataFrame, match_iou: float = 0.5) -> DataFrame:
    """Detection, segmentation and panoptic quality at an IoU above one half.

    Above one half a pair is unique on both sides, so no matching is needed. A lower
    threshold takes the pairs of ``match_instances``.
    """
    if match_iou < 0.5:
        pairs = match_instances(pairs, "iou")
    hits = pairs.filter(F.col("iou") > match_iou).groupBy("img").agg(
        F.count("*").alias("tp"), F.sum("iou").alias("iou")
    )
    n_true = _areas(masks, "true_id", "a").groupBy("img").agg(F.count("*").alias("nt"))
    n_pred = _areas(masks, "pred_id", "a").groupBy("img").agg(F.count("*").alias("np"))
    joined = n_true.join(n_pred, "img", "full").join(hits, "img", "left").na.fill(0)
    dq = ratio(F.col("tp"), F.col("tp") + 0.5 * (F.col("np") - F.col("tp")) + 0.5 * (F.col("nt") - F.col("tp")))
    sq = F.col("iou") / (F.col("tp") + 1e-6)
    return joined.select("img", dq.alias("dq"), sq.alias("sq"), (dq * sq).alias("pq"))


def _best_matching(gain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One-to-one pairs of greatest total gain in a small table (rows may stay free)."""
    rows, cols = gain.shape
    n = max(rows, cols)
    cost = np.zeros((n + 1, n + 1))
    cost[1 : rows + 1, 1 : cols + 1] = -gain
    u, v = np.zeros(n + 1), np.zeros(n + 1)
    owner = np.zeros(n + 1, dtype=int)
    for i in range(1, n + 1):
        owner[0], j0 = i, 0
        low = np.full(n + 1, np.inf)
        back = np.zeros(n + 1, dtype=int)
        done = np.zeros(n + 1, dtype=bool)
        while owner[j0]:
            done[j0] = True
            reduced = cost[owner[j0]] - u[owner[j0]] - v
            better = ~done & (reduced < low)
            low[better], back[better] = reduced[better], j0
            free = np.where(done, np.inf, low)
            free[0] = np.inf
            j1 = int(free.argmin())
            delta = free[j1]
            u[owner[done]] += delta
            v[done] -= delta
            low[~done] -= delta
            j0 = j1
        while j0:
            owner[j0] = owner[back[j0]]
            j0 = back[j0]
    row = np.array([owner[j] - 1 for j in range(1, cols + 1)])
    keep = row < rows
    pick_row, pick_col = row[keep], np.arange(cols)[keep]
    positive = gain[pick_row, pick_col] > 0
    return pick_row[positive], pick_col[positive]


def match_instances(pairs: DataFrame, gain: str, left: str = "true_id", right: str = "pred_id") -> DataFrame:
    """One-to-one pairs of greatest total gain per image.

    ``pairs`` lists the candidate pairs (positive gain). An optimal matching splits
    over the connected components of the candidate graph, so components are found
    by label contraction and each is solved on its own. A component is a clump of
    touching instances.
    """
    a = F.struct("img", F.lit(0).alias("side"), F.col(left).cast("long").alias("k"))
    b = F.struct("img", F.lit(1).alias("side"), F.col(right).cast("long").alias("k"))
    roots = contract_labels(pairs.select(a.alias("a"), b.alias("b")))
    tagged = pairs.withColumn("id", a).join(roots, "id").drop("id")
    # Where a pair is its whole component there is nothing to choose.
    sizes = tagged.groupBy("root").agg(F.count("*").alias("_c"))
    counted = tagged.join(sizes, "root")
    single = counted.filter("_c = 1").drop("_c", "root")
    kinds = dict(pairs.dtypes)
    columns = pairs.columns

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        rows, row = np.unique(pdf[left].to_numpy(), return_inverse=True)
        cols, col = np.unique(pdf[right].to_numpy(), return_inverse=True)
        table = np.zeros((len(rows), len(cols)))
        index = np.full(table.shape, -1)
        table[row, col] = pdf[gain].to_numpy(dtype=float)
        index[row, col] = np.arange(len(pdf))
        i, j = _best_matching(table)
        picked = index[i, j]
        return pdf.iloc[picked[picked >= 0]][columns]

    schema = ", ".join(f"{c} {kinds[c]}" for c in columns)
    many = counted.filter("_c > 1").drop("_c")
    return single.select(*columns).unionByName(spread_by(many, "root").groupBy("root").applyInPandas(solve, schema))


def jaccard_index_plus(masks: DataFrame, pairs: DataFrame) -> DataFrame:
    """Aggregated Jaccard with one-to-one pairs."""
    chosen = match_instances(pairs, "iou")
    return _jaccard(masks, chosen).withColumnRenamed("aji", "aji_plus")


def match_points(true: DataFrame, pred: DataFrame, radius: float = 12.0) -> DataFrame:
    """One-to-one pairs of centroids within a radius: as many as possible, then the closest.

    Both sides have (img, inst_id, cx, cy, type). Candidates come from a grid
    equi-join with cells as wide as the radius.
    """
    def keyed(df: DataFrame, p: str) -> DataFrame:
        return df.select(
            "img",
            *[F.col(c).alias(f"{p}_{c}") for c in ("inst_id", "cx", "cy", "type")],
            F.floor(F.col("cx") / radius).alias("gx"),
            F.floor(F.col("cy") / radius).alias("gy"),
        )

    around = F.array(F.lit(-1), F.lit(0), F.lit(1))
    spread = (
        keyed(pred, "pred")
        .withColumn("_a", F.explode(around))
        .withColumn("_b", F.explode(around))
        .withColumn("gx", F.col("gx") + F.col("_a"))
        .withColumn("gy", F.col("gy") + F.col("_b"))
        .drop("_a", "_b")
    )
    square = F.pow(F.col("true_cx") - F.col("pred_cx"), 2) + F.pow(F.col("true_cy") - F.col("pred_cy"), 2)
    near = keyed(true, "true").join(spread, ["img", "gx", "gy"]).withColumn("distance", F.sqrt(square))
    # A match is worth more than any saving in distance.
    worth = near.filter(F.col("distance") <= radius).withColumn(
        "gain", F.lit(1e6) - F.col("distance")
    )
    candidates = worth.select(
        "img", "true_inst_id", "pred_inst_id", "true_type", "pred_type", "distance", "gain"
    )
    return match_instances(candidates, "gain", "true_inst_id", "pred_inst_id").drop("gain")


def type_statistics(
    true: DataFrame, pred: DataFrame, paired: DataFrame, types: Sequence[int], exhaustive: bool = True
) -> DataFrame:
    """One row: detection F1, type accuracy, and a type-aware F1 for every type."""
    lone_true = true.join(
        paired.select("img", F.col("true_inst_id").alias("inst_id")), ["img", "inst_id"], "left_anti"
    )
    lone_pred = pred.join(
        paired.select("img", F.col("pred_inst_id").alias("inst_id")), ["img", "inst_id"], "left_anti"
    )
    rows = (
        paired.select(F.lit("pair").alias("kind"), F.col("true_type").alias("t"), F.col("pred_type").alias("p"))
        .unionByName(lone_true.select(F.lit("true").alias("kind"), F.col("type").alias("t"), F.lit(None).cast("int").alias("p")))
        .unionByName(lone_pred.select(F.lit("pred").alias("kind"), F.lit(None).cast("int").alias("t"), F.col("type").alias("p")))
    )
    pair = F.col("kind") == "pair"
    t, p = F.col("t"), F.col("p")

    def count(cond: Column) -> Column:
        return F.count_if(cond).cast("double")

    n_pair, fp, fn = count(pair), count(F.col("kind") == "pred"), count(F.col("kind") == "true")
    ignored = F.lit(0.0) if exhaustive else count(pair & (t == -1))
    right = count(pair & (t == p))
    outputs = [
        F.try_divide(2 * n_pair, 2 * n_pair + fp + fn).alias("f1_detection"),
        F.try_divide(right, right + count(pair & (t != p)) - ignored).alias("type_accuracy"),
    ]
    for k in types:
        either = pair & ((t == k) | (p == k))
        tp = count(pair & (t == k) & (p == k))
        fp_dt = count(pair & (t != k) & (p == k))
        if not exhaustive:
            fp_dt = fp_dt - count(either & (t == -1))
        fn_dt = count(pair & (t == k) & (p != k))
        fp_d = count((F.col("kind") == "pred") & (p == k))
        fn_d = count((F.col("kind") == "true") & (t == k))
        outputs.append(
            F.try_divide(2 * tp, 2 * tp + 2 * fp_dt + 2 * fn_dt + fp_d + fn_d).alias(f"f1_type_{k}")
        )
    return rows.agg(*outputs)


def mean_scores(*per_image: DataFrame) -> DataFrame:
    """Mean of every score over the images."""
    joined = per_image[0]
    for other in per_image[1:]:
        joined = joined.join(other, "img", "full")
    names = [c for c in joined.columns if c != "img"]
    return joined.agg(*[F.avg(c).alias(c) for c in names])


def validation_scalars(pixels: DataFrame, types: Sequence[int]) -> DataFrame:
    """Pixel accuracy and Dice, a Dice per type, and the squared error of the maps.

    ``pixels``: prob, true (0/1), true_type, pred_type, and true/pred h and v.
    """
    guess = (F.col("prob") > 0.5).cast("int")
    n = F.count("*").cast("double")

    def dice(a: Column, b: Column) -> Column:
        both = F.count_if(a & b).cast("double")
        return 2 * both / (F.count_if(a) + F.count_if(b) + 1e-8)

    error = F.pow(F.col("pred_h") - F.col("true_h"), 2) + F.pow(F.col("pred_v") - F.col("true_v"), 2)
    return pixels.agg(
        (F.count_if(guess == F.col("true")) / n).alias("np_acc"),
        dice(F.col("true") == 1, guess == 1).alias("np_dice"),
        *[
            dice(F.col("true_type") == k, F.col("pred_type") == k).alias(f"tp_dice_{k}")
            for k in types
        ],
        (F.sum(error) / n).alias("hv_mse"),
    )


def confusion(pixels: DataFrame, true: str, pred: str) -> DataFrame:
    """(True, Pred, value) records."""
    return pixels.groupBy(F.col(true).alias("True"), F.col(pred).alias("Pred")).agg(
        F.count("*").alias("value")
    )


def loss_terms(pixels: DataFrame, by: str, prob: str, truth: str) -> DataFrame:
    """Soft Dice, mean squared error and cross-entropy of predictions as folds."""
    p, t = F.col(prob).cast("double"), F.col(truth).cast("double")
    safe = F.greatest(F.least(p, F.lit(1 - 1e-7)), F.lit(1e-7))
    smooth = 1e-3
    return pixels.groupBy(by).agg(
        (1 - (2 * F.sum(p * t) + smooth) / (F.sum(p) + F.sum(t) + smooth)).alias("dice_loss"),
        F.avg((p - t) * (p - t)).alias("mse_loss"),
        F.avg(-(t * F.ln(safe) + (1 - t) * F.ln(1 - safe))).alias("bce_loss"),
    )
