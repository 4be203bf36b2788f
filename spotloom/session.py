"""Session settings and lineage helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "spotloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's defaults.

    Nothing here names a machine: on a cluster the master, memory and the
    checkpoint folder come from the submit configuration.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(app: str = "spotloom-local", cpus: int | None = None) -> SparkSession:
    cpus = cpus or os.cpu_count() or 4
    return build_session(
        app,
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": str(cpus),
            "spark.driver.memory": os.environ.get("SPOTLOOM_DRIVER_MEMORY", "12g"),
        },
    )


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder named by ``spark.checkpoint.dir``; make one only in local mode."""
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    if configured:
        context.setCheckpointDir(configured)
        return
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="spotloom-checkpoint-"))


CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the files outlive the executor that wrote them.

    Spark removes the shuffle files of the plan once the checkpoint is written; they would
    else stay until the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    before = spark.conf.get(CLEAN_UP)
    spark.conf.set(CLEAN_UP, "true")
    try:
        # a plan of its own, which takes the setting and shares no shuffle with other runs of df
        return df.select("*").checkpoint(eager=True)
    finally:
        spark.conf.set(CLEAN_UP, before)


def spread_by(df: DataFrame, *keys: str, waves: int = 4) -> DataFrame:
    """Hash-partition rows by keys into a fixed number of tasks.

    Groups that are costly to solve are often small in bytes, and the adaptive
    planner would merge them into a few tasks. A fixed number keeps all cores busy;
    a grouped function over the same keys needs no further shuffle.
    """
    spark = df.sparkSession
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return df.repartition(max(waves * spark.sparkContext.defaultParallelism, wanted), *keys)
