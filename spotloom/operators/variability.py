"""Spatially variable genes by Gaussian-process likelihood ratio.

Counts are stabilised, regressed on log total counts and fitted with a squared
exponential kernel at ten length scales. A kernel belongs to one capture area; its
number of spots is fixed by the array, and that size is checked. The work is split
by (sample, length scale); a task decomposes its kernel once and fits block after block of genes.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.probability import normal_two_sided
from ..session import cut_lineage, spread_by
from .comparative import adjust_step_up

# Number of length scales, most spots of one capture area.
N_SCALES = 10
MAX_SPOTS = 20_000


def residuals(expr: DataFrame, spots: DataFrame) -> DataFrame:
    """(exp_id, gene, entries) residual expression of every spot with counts.

    The stabilised value of a zero is the same for all genes, so entries stay
    sparse: what is stored is log(x + c) - log(c) before the regression, and the
    regression uses sums over nonzero entries plus the known constant.
    """
    kept = expr.join(spots.select("barcode", "exp_id"), "barcode")
    totals = kept.groupBy("exp_id", "barcode").agg(F.sum("count").cast("double").alias("total"))
    sizes = totals.groupBy("exp_id").agg(
        F.count("*").cast("double").alias("n"),
        F.avg(F.ln("total")).alias("lt_mean"),
        F.var_pop(F.ln("total")).alias("lt_var"),
    )
    x = F.col("count").cast("double")
    per_gene = (
        kept.groupBy("exp_id", "gene")
        .agg(F.sum(x).alias("s1"), F.sum(x * x).alias("s2"))
        .join(sizes, "exp_id")
        .withColumn("mu", F.col("s1") / F.col("n"))
        .withColumn("v", (F.col("s2") - F.col("s1") * F.col("mu")) / (F.col("n") - 1))
    )
    # Variance = mean + phi mean^2, fitted by least squares over the genes.
    phi = per_gene.groupBy("exp_id").agg(
        (F.sum(F.pow("mu", F.lit(2)) * (F.col("v") - F.col("mu"))) / F.sum(F.pow("mu", F.lit(4)))).alias("phi")
    ).withColumn("c", 1 / (2 * F.greatest("phi", F.lit(1e-6))))
    stable = kept.join(phi, "exp_id").join(totals, ["exp_id", "barcode"]).withColumn(
        "g", F.ln(x + F.col("c")) - F.ln("c")
    )
    folded = stable.groupBy("exp_id", "gene").agg(
        F.sum("g").alias("gs"),
        F.sum(F.col("g") * F.ln("total")).alias("gt"),
        F.sum(F.col("count")).alias("total_counts"),
        F.collect_list(F.struct("barcode", "g")).alias("entries"),
        F.any_value(F.ln("c")).alias("base"),
    )
    slope = (F.col("gt") - F.col("gs") * F.col("lt_mean")) / (F.col("n") * F.col("lt_var"))
    return folded.join(sizes, "exp_id").select(
        "exp_id", "gene", "total_counts", "entries", "base", F.coalesce(slope, F.lit(0.0)).alias("slope")
    )


def _log_likelihood(log_delta, s, uty2_terms, n):
    """Profile log-likelihood of many genes at their own noise ratio."""
    u1, uty = uty2_terms
    d = 1.0 / (s[None, :] + np.exp(log_delta)[:, None])
    mean = (d * u1[None, :] * uty).sum(axis=1) / (d * u1[None, :] ** 2).sum(axis=1)
    rest = uty - u1[None, :] * mean[:, None]
    scale = (d * rest * rest).sum(axis=1) / n
    return -0.5 * (n * math.log(2 * math.pi) - np.log(d).sum(axis=1) + n + n * np.log(np.maximum(scale, 1e-300)))


def _decomposed(kernel: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Eigenvalues and vectors of a kernel, and its Gower factor."""
    n = len(kernel)
    gower = (np.trace(kernel) - kernel.sum() / n) / (n - 1)
    s, u = np.linalg.eigh(kernel)
    return np.maximum(s, 1e-8), u, gower


def _fit(y: np.ndarray, s: np.ndarray, u: np.ndarray, gower: float) -> tuple[np.ndarray, np.ndarray]:
    """Best log-likelihood and share of spatial variance of every gene (row of y)."""
    n = y.shape[1]
    y = y - y.mean(axis=1, keepdims=True)  # the mean is fitted, so that a constant changes nothing
    u1, uty = terms = (u.sum(axis=0), y @ u)
    # On the grid all genes have the same noise ratios, so that their sums are matrix products.
    grid = np.linspace(-10, 20, 31)
    d = 1.0 / (s[:, None] + np.exp(grid)[None, :])
    cross = uty @ (d * u1[:, None])
    rest = (uty * uty) @ d - cross * cross / (u1 * u1 @ d)
    values = 0.5 * np.log(d).sum(axis=0) - 0.5 * n * np.log(np.maximum(rest / n, 1e-300))
    centre = grid[values.argmax(axis=1)]
    low, high = centre - 1, centre + 1
    golden = (math.sqrt(5) - 1) / 2
    a, b = high - golden * (high - low), low + golden * (high - low)
    at_a, at_b = (_log_likelihood(x, s, terms, n) for x in (a, b))
    for _ in range(30):
        left = at_a > at_b
        low, high = np.where(left, low, a), np.where(left, b, high)
        x = np.where(left, high - golden * (high - low), low + golden * (high - low))
        at_x = _log_likelihood(x, s, terms, n)  # the other inner point is known
        a, b, at_a, at_b = (
            np.where(left, x, b), np.where(left, a, x), np.where(left, at_x, at_b), np.where(left, at_a, at_x)
        )
    delta = (low + high) / 2
    return _log_likelihood(delta, s, terms, n), gower / (gower + np.exp(delta))


def spatial_variability(
    expr: DataFrame, spots: DataFrame, max_genes: int = 3000, block: int = 512
) -> DataFrame:
    """(exp_id, gene, LLR, pval, qval, FSV, l, total_counts) of the most expressed genes.

    ``spots`` has (exp_id, barcode, x, y).
    """
    crowded = spots.groupBy("exp_id").agg(F.count("*").alias("n")).filter(F.col("n") > MAX_SPOTS)
    if crowded.limit(1).count():
        raise ValueError(f"a capture area with more than {MAX_SPOTS} spots")
    genes = residuals(expr, spots)
    totals = expr.join(spots.select("barcode", "exp_id"), "barcode").groupBy("exp_id", "gene").agg(
        F.sum("count").alias("t")
    )
    # The cap is the operator's own: the most expressed genes of each sample.
    rank = F.row_number().over(Window.partitionBy("exp_id").orderBy(F.desc("t"), "gene"))
    best = totals.withColumn("_k", rank).filter(F.col("_k") <= max_genes).select("exp_id", "gene")
    seen = expr.select("barcode").distinct()
    places = (
        spots.join(seen, "barcode", "left_semi")
        .groupBy("exp_id")
        .agg(F.sort_array(F.collect_list(F.struct("barcode", "x", "y"))).alias("spots"))
    )
    log_totals = (
        expr.groupBy("barcode").agg(F.ln(F.sum("count").cast("double")).alias("lt"))
        .join(spots.select("barcode", "exp_id"), "barcode")
        .groupBy("exp_id")
        .agg(F.sort_array(F.collect_list(F.struct("barcode", "lt"))).alias("lts"))
    )
    scales = F.sequence(F.lit(0), F.lit(N_SCALES - 1))
    work = genes.join(best, ["exp_id", "gene"], "left_semi").withColumn("scale", F.explode(scales))
    shapes = places.join(log_totals, "exp_id")

    def fit(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        names = ["exp_id", "gene", "l", "ll", "null_ll", "fsv", "total_counts"]
        if left.empty or right.empty:
            return pd.DataFrame({n: [] for n in names})
        places_ = right["spots"].iloc[0]
        index = {p["barcode"]: i for i, p in enumerate(places_)}
        xy = np.array([[p["x"], p["y"]] for p in places_], dtype=float)
        lt = np.array([p["lt"] for p in right["lts"].iloc[0]], dtype=float)
        n = len(xy)
        square = (xy[:, None, 0] - xy[None, :, 0]) ** 2
        square += (xy[:, None, 1] - xy[None, :, 1]) ** 2
        low = math.sqrt(square.min(initial=np.inf, where=square > 1e-8)) / 2
        high = math.sqrt(square.max()) * 2
        length = np.logspace(math.log10(low), math.log10(high), N_SCALES)[int(left["scale"].iloc[0])]
        square /= -2 * length * length
        kernel = _decomposed(np.exp(square, out=square))
        out = []
        for first in range(0, len(left), block):
            part = left.iloc[first : first + block]
            y = np.zeros((len(part), n))
            for row, entries in enumerate(part["entries"]):
                for e in entries:
                    y[row, index[e["barcode"]]] = e["g"]
            y = y + part["base"].to_numpy()[:, None] - np.outer(part["slope"].to_numpy(), lt)
            ll, fsv = _fit(y, *kernel)
            null = -0.5 * (n * math.log(2 * math.pi) + n * np.log(np.maximum(y.var(axis=1), 1e-300)) + n)
            out.append(
                pd.DataFrame(
                    {
                        "exp_id": part["exp_id"], "gene": part["gene"], "l": length, "ll": ll,
                        "null_ll": null, "fsv": fsv, "total_counts": part["total_counts"],
                    }
                )
            )
        return pd.concat(out)

    kinds = dict(genes.dtypes)
    sides = shapes.select(
        F.col("exp_id").alias("area"),
        F.explode(scales).alias("area_scale"),
        "spots",
        "lts",
    )
    fitted = (
        spread_by(work, "exp_id", "scale")
        .groupBy("exp_id", "scale")
        .cogroup(spread_by(sides, "area", "area_scale").groupBy("area", "area_scale"))
        .applyInPandas(
            fit,
            f"exp_id {kinds['exp_id']}, gene {kinds['gene']}, l double, ll double, null_ll double, "
            "fsv double, total_counts long",
        )
    )
    chosen = fitted.groupBy("exp_id", "gene").agg(
        F.max_by(F.struct("l", "ll", "null_ll", "fsv", "total_counts"), F.col("ll")).alias("_m")
    )
    ratio = F.greatest(F.col("_m.ll") - F.col("_m.null_ll"), F.lit(0.0))
    scored = chosen.select(
        "exp_id", "gene", ratio.alias("LLR"), normal_two_sided(F.sqrt(ratio)).alias("pval"),
        F.col("_m.fsv").alias("FSV"), F.col("_m.l").alias("l"), F.col("_m.total_counts").alias("total_counts"),
    )
    return adjust_step_up(cut_lineage(scored), ["exp_id"], "pval", "qval")


def top_variable(scored: DataFrame, n: int, limit: float = 0.05, min_count: int = 1000) -> DataFrame:
    """Significant genes with enough counts, by q-value and then spatial share."""
    return (
        scored.filter((F.col("qval") <= limit) & (F.col("total_counts") >= min_count))
        .orderBy(F.asc_nulls_first("qval"), F.desc_nulls_first("FSV"), "gene")
        .limit(n)
    )
