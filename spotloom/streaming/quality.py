"""Quality metrics kept up to date while count files arrive.

The metrics are sums, so they update per arriving batch. This has no counterpart
in batch semantics beyond giving the same numbers once all files are in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas


def arriving_counts(spark: SparkSession, path: str, files_per_batch: int = 16) -> DataFrame:
    return (
        spark.readStream.schema(schemas.EXPRESSION)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(path)
    )


def running_spot_metrics(counts: DataFrame) -> DataFrame:
    """Detected genes and counts per spot; each (barcode, gene) arrives once."""
    return counts.filter("count > 0").groupBy("barcode").agg(
        F.count("*").alias("qc_nGenes"), F.sum("count").alias("qc_nCounts")
    )


def running_type_counts(cells: DataFrame, delay: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Cells of each type per time window, with late arrivals up to ``delay``."""
    return (
        cells.withWatermark("ts", delay)
        .groupBy(F.window("ts", width), "cell_type")
        .agg(F.count("*").alias("n"))
    )


def start_spot_metrics(
    counts: DataFrame, out: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Write each update's changed spots; the newest batch of a spot is its value."""

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(
            f"{out}/batch_id={batch_id}_part"
        )

    writer = (
        running_spot_metrics(counts)
        .writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(store)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def current_spot_metrics(spark: SparkSession, out: str) -> DataFrame:
    """Latest value of every spot, by a fold over the stored updates."""
    updates = spark.read.parquet(f"{out}/*")
    rest = [c for c in updates.columns if c not in ("barcode", "batch_id")]
    return (
        updates.groupBy("barcode")
        .agg(F.max_by(F.struct(*rest), "batch_id").alias("_v"))
        .select("barcode", "_v.*")
    )
