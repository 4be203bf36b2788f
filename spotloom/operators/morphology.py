"""Scaling, reducing and clustering of morphology vectors."""

from __future__ import annotations

from pyspark.ml.clustering import GaussianMixture, KMeans
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def standardise(cells: DataFrame, column: str = "features") -> DataFrame:
    """Subtract the mean and divide by the population deviation of every feature."""
    stats = (
        cells.select(F.posexplode(column).alias("i", "v"))
        .groupBy("i")
        .agg(F.avg("v").alias("m"), F.stddev_pop("v").alias("s"))
    )
    # One entry per feature.
    listed = stats.agg(F.sort_array(F.collect_list(F.struct("i", "m", "s")))).scalar()
    centred = F.zip_with(
        F.col(column),
        F.col("_stats"),
        lambda v, s: F.when(s["s"] > 0, (v - s["m"]) / s["s"]).otherwise(v - s["m"]),
    )
    return cells.withColumn("_stats", listed).withColumn(column, centred).drop("_stats")


def reduce(cells: DataFrame, k: int = 10, column: str = "features") -> DataFrame:
    """First k principal components (signs are arbitrary)."""
    vectors = cells.withColumn("_v", array_to_vector(F.col(column)))
    model = PCA(k=k, inputCol="_v", outputCol="_p").fit(vectors.select("_v"))
    projected = model.transform(vectors)
    return projected.withColumn(column, vector_to_array(F.col("_p"))).drop("_v", "_p")


MODELS = {
    "gaussian": lambda k, seed: GaussianMixture(k=k, seed=seed, featuresCol="_v", predictionCol="clusters"),
    "kmeans": lambda k, seed: KMeans(k=k, seed=seed, featuresCol="_v", predictionCol="clusters"),
}


def cluster(
    cells: DataFrame, method: str = "gaussian", k: int = 5, seed: int = 0, column: str = "features"
) -> DataFrame:
    """Add ``clusters`` from a model chosen by name."""
    if method not in MODELS:
        raise ValueError(f"unknown clustering method {method!r}; one of {sorted(MODELS)}")
    vectors = cells.withColumn("_v", array_to_vector(F.col(column)))
    model = MODELS[method](k, seed).fit(vectors.select("_v"))
    return model.transform(vectors).drop("_v", "probability")
