"""From abundances to integer cell counts per type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import ratio
from .merge import proportions


def threshold_abundance(long: DataFrame, threshold: float, value: str = "n") -> DataFrame:
    """Abundance below the threshold counts as absent."""
    return long.withColumn(value, F.when(F.col(value) < threshold, F.lit(0)).otherwise(F.col(value)))


def non_empty_types(long: DataFrame, value: str = "n") -> DataFrame:
    """Types with cells, plus the number of distinct types and cells of their spot."""
    types = Window.partitionBy("barcode")
    return long.filter(F.col(value) > 0).select(
        "*",
        F.count("*").over(types).alias("distinct_cell_types"),
        F.sum(value).over(types).alias("cell_n"),
    )


def type_distribution(long: DataFrame, value: str = "n") -> DataFrame:
    """Share of every present type in its spot."""
    kept = non_empty_types(long, value)
    return kept.select(
        "barcode", "cell_type", ratio(F.col(value), F.col("cell_n")).alias("share")
    )


def apportion(props: Column, n: Column) -> Column:
    """Split n items over bins: each goes to the bin furthest below its proportion.

    The first bin wins ties. ``props`` has one entry per cell type (tens), n is
    the number of cells of a spot.
    """
    zero = F.transform(props, lambda _: F.lit(0.0))

    def place(dist: Column, step: Column) -> Column:
        total = F.greatest(step.cast("double") - 1, F.lit(1.0))
        errors = F.zip_with(props, dist, lambda p, c: p - c / total)
        best = F.array_position(errors, F.array_max(errors))
        return F.transform(dist, lambda c, i: F.when(i + 1 == best, c + 1).otherwise(c))

    steps = F.when(n >= 1, F.sequence(F.lit(1), n.cast("int"))).otherwise(
        F.array().cast("array<int>")
    )
    return F.aggregate(steps, zero, place)


def apportion_by_rank(long: DataFrame, cells: DataFrame) -> DataFrame:
    """Integer counts of each type for every spot (barcode, cell_type, n).

    ``long`` holds (barcode, cell_type, proportion), ``cells`` (barcode, cell_n).
    Spots carry tens of types, so their arrays are small.
    """
    props = long.groupBy("barcode").agg(
        F.array_sort(F.collect_list(F.struct("cell_type", "proportion"))).alias("_p")
    )
    joined = props.join(cells, "barcode", "left").na.fill(0, ["cell_n"])
    counted = joined.withColumn(
        "_n", apportion(F.transform("_p", lambda p: p["proportion"]), F.col("cell_n"))
    )
    zipped = F.arrays_zip(F.transform("_p", lambda p: p["cell_type"]).alias("cell_type"), F.col("_n").alias("n"))
    return counted.select("barcode", F.explode(zipped).alias("_z")).select(
        "barcode", F.col("_z.cell_type").alias("cell_type"), F.col("_z.n").cast("long").alias("n")
    )


def counts_from_abundance(
    abundance: DataFrame, cells: DataFrame, threshold: float = 0.1
) -> DataFrame:
    """Threshold, normalise per spot and apportion over the cells inside the spot."""
    kept = threshold_abundance(abundance, threshold, "abundance")
    return apportion_by_rank(proportions(kept, value="abundance"), cells)
