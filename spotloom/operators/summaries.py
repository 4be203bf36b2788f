"""Counts, distributions and entropies of cell types over spots and clusters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import ratio


def type_counts(cells: DataFrame) -> DataFrame:
    """(barcode, cell_type, n) of cells that have a spot."""
    return (
        cells.filter(F.col("barcode").isNotNull())
        .groupBy("barcode", "cell_type")
        .agg(F.count("*").alias("n"))
    )


def spot_type_table(cells: DataFrame, types: Sequence[str]) -> DataFrame:
    """Spots x types with zeros; only spots that hold at least one cell appear."""
    return type_counts(cells).groupBy("barcode").pivot("cell_type", list(types)).agg(
        F.sum("n")
    ).na.fill(0)


def cells_per_type(cells: DataFrame) -> DataFrame:
    return (
        cells.groupBy("cell_type")
        .agg(F.count("barcode").alias("cell_count"))
        .orderBy(F.desc("cell_count"), "cell_type")
    )


def spot_statistics(cells: DataFrame) -> DataFrame:
    """Per type: count, mean, median, max, min, sample std and deciles over spots.

    A spot without the type counts as zero. The per-type distribution is a
    histogram of the count values, so its size follows the number of different
    counts in a spot, not the number of spots. Quantiles interpolate linearly.
    """
    counts = type_counts(cells)
    n_spots = counts.select("barcode").distinct().agg(F.count("*")).scalar()
    hist = counts.groupBy("cell_type", "n").agg(F.count("*").alias("spots"))
    by_type = Window.partitionBy("cell_type")
    steps = hist.withColumn("n_spots", n_spots).select(
        "*",
        (F.col("n_spots") - F.sum("spots").over(by_type)).alias("zeros"),
        F.sum("spots").over(by_type.orderBy("n")).alias("cum"),
    )

    def at(rank: Column) -> Column:
        found = F.min(F.when(F.col("zeros") + F.col("cum") > rank, F.col("n")))
        return F.when(F.any_value(rank < F.col("zeros")), F.lit(0)).otherwise(found)

    def quantile(q: float) -> Column:
        pos = F.lit(q) * (F.col("n_spots") - 1)
        low, high = at(F.floor(pos)), at(F.ceil(pos))
        return low + (high - low) * F.any_value(pos - F.floor(pos))

    total = F.sum(F.col("n") * F.col("spots")).cast("double")
    squares = F.sum(F.col("n") * F.col("n") * F.col("spots")).cast("double")
    size = F.any_value("n_spots").cast("double")
    return (
        steps.groupBy("cell_type")
        .agg(
            F.sum(F.col("n") * F.col("spots")).alias("cell_count"),
            F.round(total / size, 2).alias("avg_spot"),
            F.round(quantile(0.5), 2).alias("median_spot"),
            F.max("n").alias("max_spot"),
            F.when(F.any_value("zeros") > 0, F.lit(0).cast("long"))
            .otherwise(F.min("n"))
            .alias("min_spot"),
            F.round(F.sqrt(F.try_divide(squares - total * total / size, size - 1)), 2).alias(
                "std_spot"
            ),
            F.round(quantile(0.9), 2).alias("p90_spot"),
            F.round(quantile(0.1), 2).alias("p10_spot"),
        )
        .orderBy(F.desc("cell_count"), "cell_type")
    )


def spot_probability(cells: DataFrame, type_col: str = "cell_type") -> DataFrame:
    """P(type | spot) as a long table."""
    counts = (
        cells.filter(F.col("barcode").isNotNull() & F.col(type_col).isNotNull())
        .groupBy("barcode", F.col(type_col).alias("cell_type"))
        .agg(F.count("*").alias("n"))
    )
    total = F.sum("n").over(Window.partitionBy("barcode"))
    return counts.select("barcode", "cell_type", ratio(F.col("n"), total).alias("p_spot"))


def cluster_probability(cells: DataFrame, p_spot: DataFrame) -> DataFrame:
    """P(type | morphology cluster): spot probabilities summed over the cluster's cells.

    Cells fold to (cluster, spot) counts first, so the join is per pair, not per cell.
    """
    weights = (
        cells.filter(F.col("barcode").isNotNull())
        .groupBy("cluster_name", "barcode")
        .agg(F.count("*").alias("w"))
    )
    sums = (
        weights.join(p_spot, "barcode")
        .groupBy("cluster_name", "cell_type")
        .agg(F.sum(F.col("w") * F.col("p_spot")).alias("s"))
    )
    total = F.sum("s").over(Window.partitionBy("cluster_name"))
    return sums.select("cluster_name", "cell_type", ratio(F.col("s"), total).alias("p_cluster"))


def combined_probability(
    cells: DataFrame, p_spot: DataFrame, p_cluster: DataFrame
) -> DataFrame:
    """P(type | spot, cluster) for the clusters that occur in each spot.

    Cluster probabilities are renormalised over the types of the spot, multiplied
    by the spot probability and renormalised again. The first renormalisation
    divides all types of a (spot, cluster) by one number, so it cancels.
    """
    present = cells.filter(F.col("barcode").isNotNull()).select("barcode", "cluster_name").distinct()
    joint = (
        present.join(p_spot, "barcode")
        .join(p_cluster, ["cluster_name", "cell_type"], "left")
        .withColumn("w", F.coalesce(F.col("p_cluster"), F.lit(0.0)) * F.col("p_spot"))
    )
    total = F.sum("w").over(Window.partitionBy("barcode", "cluster_name"))
    return joint.select(
        "barcode", "cluster_name", "cell_type", ratio(F.col("w"), total).alias("p_combined")
    )


def label_entropy(df: DataFrame, key: str, label: str) -> DataFrame:
    """Shannon entropy (natural log) and entropy over ln(number of labels)."""
    counts = df.groupBy(key, label).agg(F.count("*").alias("c"))
    folded = counts.groupBy(key).agg(
        F.sum("c").cast("double").alias("n"),
        F.sum(F.col("c") * F.ln(F.col("c").cast("double"))).alias("s"),
        F.count("*").alias("k"),
    )
    entropy = F.greatest(F.ln("n") - F.col("s") / F.col("n"), F.lit(0.0))
    return folded.select(
        key,
        entropy.alias("shannon_entropy"),
        F.when(F.col("k") == 1, entropy)
        .otherwise(entropy / F.ln(F.col("k").cast("double")))
        .alias("normalized_entropy"),
    )
