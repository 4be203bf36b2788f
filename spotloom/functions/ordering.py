"""Ordered running totals that never sort a whole hot group in one task.

A window over ``keys`` alone puts every row of a hot key into one task. Here the
rows of a key are first cut into value ranges (``bucket``). The totals of the
ranges are few (their number does not grow with the data) and give each range its
starting offset; the window then runs per (key, range).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    bucket: Column,
    order: Sequence[Column],
    value: Column,
    out: str,
    exclusive: bool = False,
    total: str | None = None,
) -> DataFrame:
    """Add ``out`` = sum of ``value`` over rows up to (or before) this one.

    ``total`` names an extra column with the sum over the whole key.
    """
    keys = list(keys)
    work = df.withColumn("_bucket", bucket).withColumn("_value", value)
    totals = work.groupBy(*keys, "_bucket").agg(F.sum("_value").alias("_total"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    whole = [] if total is None else [F.sum("_total").over(Window.partitionBy(*keys)).alias(total)]
    offsets = totals.select(
        *keys,
        "_bucket",
        F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"),
        *whole,
    )
    inner = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    inner = inner.rowsBetween(Window.unboundedPreceding, -1 if exclusive else 0)
    joined = work.join(offsets, [*keys, "_bucket"])
    return joined.withColumn(
        out, F.col("_offset") + F.coalesce(F.sum("_value").over(inner), F.lit(0))
    ).drop("_bucket", "_value", "_offset")


def running_min_from_top(
    df: DataFrame,
    keys: Sequence[str],
    bucket: Column,
    order: Column,
    value: Column,
    out: str,
) -> DataFrame:
    """Add ``out`` = min of ``value`` over rows at or above this one in ``order``."""
    keys = list(keys)
    work = df.withColumn("_bucket", bucket).withColumn("_value", value)
    lows = work.groupBy(*keys, "_bucket").agg(F.min("_value").alias("_low"))
    above = Window.partitionBy(*keys).orderBy(F.col("_bucket").desc()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = lows.select(*keys, "_bucket", F.min("_low").over(above).alias("_offset"))
    inner = (
        Window.partitionBy(*keys, "_bucket")
        .orderBy(order.desc())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    joined = work.join(offsets, [*keys, "_bucket"])
    return joined.withColumn(
        out, F.least(F.col("_offset"), F.min("_value").over(inner))
    ).drop("_bucket", "_value", "_offset")
