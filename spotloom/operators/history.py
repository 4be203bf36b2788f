"""Running values over a training history."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ordering import running_sum


def _states_before(items: DataFrame, key: str, block: int, levels: int) -> DataFrame:
    """(key, n, before): the state ahead of each step of state = state * decay + push.

    ``items`` has (key, n, decay, push) with n = 1, 2, ... per key. A block of steps
    is one step of the same form, so blocks are scanned by the same rule one level
    up and hand their state down. No array is longer than a block; the top level
    holds one entry per block ** levels steps.
    """
    grouping = [key] if levels == 0 else [key, "_b"]
    blocked = items.withColumn("_b", F.floor((F.col("n") - 1) / block))
    arrays = blocked.groupBy(*grouping).agg(
        F.sort_array(F.collect_list(F.struct("n", "decay", "push"))).alias("_i")
    )
    if levels == 0:
        started = arrays.withColumn("_carry", F.lit(0.0))
    else:
        totals = arrays.select(
            key,
            (F.col("_b") + 1).alias("n"),
            F.aggregate("_i", F.lit(1.0), lambda acc, i: acc * i["decay"]).alias("decay"),
            F.aggregate("_i", F.lit(0.0), lambda acc, i: acc * i["decay"] + i["push"]).alias("push"),
        )
        above = _states_before(totals, key, block, levels - 1)
        carried = above.select(key, (F.col("n") - 1).alias("_b"), F.col("before").alias("_carry"))
        started = arrays.join(carried, [key, "_b"])
    empty = F.array().cast("array<struct<n:bigint,before:double>>")
    scanned = F.aggregate(
        "_i",
        F.struct(F.col("_carry").alias("v"), empty.alias("out")),
        lambda acc, i: F.struct(
            (acc["v"] * i["decay"] + i["push"]).alias("v"),
            F.concat(
                acc["out"],
                F.array(F.struct(i["n"].cast("long").alias("n"), acc["v"].alias("before"))),
            ).alias("out"),
        ),
        lambda acc: acc["out"],
    )
    return started.select(key, F.explode(scanned).alias("_o")).select(key, "_o.*")


def moving_average(
    history: DataFrame,
    key: str,
    step: str,
    value: str,
    alpha: float = 0.95,
    block: int = 256,
    levels: int = 2,
) -> DataFrame:
    """Exponential moving average seeded by the first value, for every step.

    new = alpha * old + (1 - alpha) * x.
    """
    numbered = running_sum(
        history, [key], F.floor(F.col(step) / block), [F.col(step)], F.lit(1), "n"
    )
    push = F.when(F.col("n") == 1, F.col(value)).otherwise((1 - alpha) * F.col(value))
    items = numbered.select(
        key, step, F.col("n").cast("long").alias("n"), F.lit(float(alpha)).alias("decay"), push.alias("push")
    )
    before = _states_before(items.drop(step), key, block, levels)
    return items.join(before, [key, "n"]).select(
        key, step, (F.col("before") * F.col("decay") + F.col("push")).alias("ema")
    )


def best_so_far(
    history: DataFrame, key: str, step: str, value: str, larger_is_better: bool = True, block: int = 4096
) -> DataFrame:
    """Every step with whether it beats all earlier steps of its history.

    The best of earlier blocks of steps meets the running best inside the block.
    """
    pick = F.max if larger_is_better else F.min
    worst = float("-inf") if larger_is_better else float("inf")
    work = history.withColumn("_b", F.floor(F.col(step) / block))
    tops = work.groupBy(key, "_b").agg(pick(value).alias("_t"))
    before = Window.partitionBy(key).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = tops.select(key, "_b", pick("_t").over(before).alias("_carry"))
    inner = Window.partitionBy(key, "_b").orderBy(step).rowsBetween(Window.unboundedPreceding, -1)
    both = F.greatest if larger_is_better else F.least
    best = F.coalesce(both(F.col("_carry"), pick(value).over(inner)), F.lit(worst))
    joined = work.join(carried, [key, "_b"]).withColumn("previous_best", best)
    ahead = F.col(value) > F.col("previous_best") if larger_is_better else F.col(value) < F.col("previous_best")
    return joined.select(key, step, value, ahead.alias("is_best"))


def epoch_means(raw: DataFrame, epoch: str, metric: str, value: str) -> DataFrame:
    """Batch outputs of an epoch reduced once."""
    return raw.groupBy(epoch, metric).agg(F.count("*").alias("batches"), F.avg(value).alias("mean"))
