"""Tissue tables derived from the given relational tables.

Each builder has a twin in ``CTES``: the same derivation as DuckDB text. Extents
grow with the row counts (a slide gets longer, never denser), so the neighbour
counts per point stay constant at any scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .session import spread_by

SPOT_DIAMETER = 65.0
SPOT_RADIUS = SPOT_DIAMETER // 2
STEP = int(SPOT_DIAMETER)
ROW_PITCH = 87  # px between lattice rows
COL_PITCH = 50  # px per lattice column step
SPOTS_PER_ROW = 32
CELLS_PER_ROW = 3200

# Six corners of a region around its centre, counter-clockwise, one of them concave.
REGION_SHAPE = [
    (-160.5, -120.5),
    (170.5, -140.5),
    (180.5, 20.5),
    (20.5, 30.5),
    (10.5, 150.5),
    (-150.5, 140.5),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(cells: DataFrame) -> DataFrame:
    """Deal cells over the session's tasks before heavy per-cell work."""
    return spread_by(cells, "cell_ids")


def expr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse counts (barcode, gene, count); zeros are absent."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_suppkey").alias("barcode"), F.col("l_partkey").alias("gene"))
        .agg(F.sum("l_quantity").cast("long").alias("count"))
        .filter("count > 0")
    )


def spots(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = F.expr(f"s_suppkey div {SPOTS_PER_ROW}")
    return (
        table(spark, sf_dir, "supplier")
        .select(
            F.col("s_suppkey").alias("barcode"),
            (F.col("s_acctbal") > 0).cast("int").alias("in_tissue"),
            row.cast("int").alias("array_row"),
            (2 * (F.col("s_suppkey") % SPOTS_PER_ROW) + row % 2).cast("int").alias("array_col"),
            F.expr("s_nationkey % 5").cast("int").alias("cluster"),
            F.col("s_acctbal").alias("score"),
        )
        .withColumn("pxl_row_in_fullres", F.col("array_row") * ROW_PITCH)
        .withColumn("pxl_col_in_fullres", F.col("array_col") * COL_PITCH)
    )


def genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("gene"),
        F.concat_ws("-", "p_type", F.upper("p_name"), F.col("p_partkey").cast("string")).alias(
            "gene_name"
        ),
        F.col("p_brand").alias("brand"),
    )


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segmented cells with centroid, area, type and morphology cluster."""
    band = F.expr(f"event_id div {CELLS_PER_ROW}")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("cell_ids"),
        ((F.col("event_id") * 104729) % 3203).cast("double").alias("cell_x"),
        (band * ROW_PITCH + (F.col("event_id") * 7919) % ROW_PITCH).cast("double").alias("cell_y"),
        F.col("event_type").alias("cell_type"),
        F.col("value").alias("area"),
    )


def assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells that already know their spot, plus a morphology cluster."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("cell_ids"),
        F.col("user_id").alias("barcode"),
        F.col("event_type").alias("cell_type"),
        F.expr("cast(get_json_object(props, '$.k') as int) div 10").cast("int").alias("cluster_name"),
        F.col("value").alias("area"),
    )


def deconv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Estimated number of cells of each type in each spot."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("barcode"), F.col("o_orderpriority").alias("cell_type"))
        .agg(F.count("*").alias("n"))
    )


def masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixels with a true and a predicted instance id; 64 x 64 pixels per image."""
    y = F.expr("(o_orderkey % 4096) div 64")
    x = F.expr("o_orderkey % 64")
    hole_true = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "5-LOW")
    hole_pred = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT")

    def block(row: Column, col: Column) -> Column:
        return F.floor(row / 8) * 9 + F.floor(col / 8) + 1

    return table(spark, sf_dir, "orders").select(
        F.expr("o_orderkey div 4096").alias("img"),
        y.cast("int").alias("y"),
        x.cast("int").alias("x"),
        F.when(hole_true, 0).otherwise(block(y, x)).cast("int").alias("true_id"),
        F.when(hole_pred, 0).otherwise(block(y, x + 1)).cast("int").alias("pred_id"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("pixel_type"),
        F.col("o_totalprice").alias("intensity"),
    )


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotation polygons: one around every high-scoring spot."""
    corners = F.array(
        *[
            F.struct(
                (F.col("pxl_col_in_fullres") + dx).alias("x"),
                (F.col("pxl_row_in_fullres") + dy).alias("y"),
            )
            for dx, dy in REGION_SHAPE
        ]
    )
    return (
        spots(spark, sf_dir)
        .filter("score >= 8500")
        .select(
            F.concat(F.lit("class_"), F.col("cluster").cast("string")).alias("region_class"),
            F.col("barcode").alias("region_name"),
            corners.alias("ring"),
        )
    )


def morph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Morphology vectors; 25 consecutive cells share a spot."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("cell_ids"),
        F.expr("vec_id div 25").alias("barcode"),
        F.col("embedding").cast("array<double>").alias("features"),
        F.col("label").alias("spot_clusters"),
    )


def experiments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Experiment of every spot (multi-sample grouping)."""
    sample = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("s_nationkey"), F.col("n_regionkey").alias("exp_id")
    )
    return (
        table(spark, sf_dir, "supplier")
        .join(sample, "s_nationkey")
        .select(F.col("s_suppkey").alias("barcode"), "exp_id")
    )


def _corner_sql() -> str:
    return ", ".join(
        f"({i}, {dx}::double, {dy}::double)" for i, (dx, dy) in enumerate(REGION_SHAPE)
    )


CTES: dict[str, str] = {
    "expr": """expr AS (
        SELECT l_suppkey AS barcode, l_partkey AS gene, sum(l_quantity)::bigint AS count
        FROM lineitem GROUP BY 1, 2 HAVING sum(l_quantity) > 0)""",
    "spots": f"""spots AS (
        SELECT s_suppkey AS barcode, (s_acctbal > 0)::int AS in_tissue,
               (s_suppkey // {SPOTS_PER_ROW})::int AS array_row,
               (2 * (s_suppkey % {SPOTS_PER_ROW}) + (s_suppkey // {SPOTS_PER_ROW}) % 2)::int AS array_col,
               (s_nationkey % 5)::int AS cluster, s_acctbal AS score,
               (s_suppkey // {SPOTS_PER_ROW})::int * {ROW_PITCH} AS pxl_row_in_fullres,
               (2 * (s_suppkey % {SPOTS_PER_ROW}) + (s_suppkey // {SPOTS_PER_ROW}) % 2)::int * {COL_PITCH}
                   AS pxl_col_in_fullres
        FROM supplier)""",
    "genes": """genes AS (
        SELECT p_partkey AS gene, p_type || '-' || upper(p_name) || '-' || p_partkey::varchar AS gene_name,
               p_brand AS brand FROM part)""",
    "cells": f"""cells AS (
        SELECT event_id AS cell_ids, ((event_id * 104729) % 3203)::double AS cell_x,
               ((event_id // {CELLS_PER_ROW}) * {ROW_PITCH} + (event_id * 7919) % {ROW_PITCH})::double AS cell_y,
               event_type AS cell_type, value AS area
        FROM events)""",
    "assigned": """assigned AS (
        SELECT event_id AS cell_ids, user_id AS barcode, event_type AS cell_type,
               (json_extract_string(props, '$.k')::int // 10)::int AS cluster_name, value AS area
        FROM events)""",
    "deconv": """deconv AS (
        SELECT o_custkey AS barcode, o_orderpriority AS cell_type, count(*) AS n
        FROM orders GROUP BY 1, 2)""",
    "masks": """masks AS (
        SELECT o_orderkey // 4096 AS img, ((o_orderkey % 4096) // 64)::int AS y, (o_orderkey % 64)::int AS x,
               CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '5-LOW' THEN 0
                    ELSE ((o_orderkey % 4096) // 64 // 8) * 9 + (o_orderkey % 64) // 8 + 1 END::int AS true_id,
               CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 0
                    ELSE ((o_orderkey % 4096) // 64 // 8) * 9 + (o_orderkey % 64 + 1) // 8 + 1 END::int AS pred_id,
               o_orderpriority[1]::int AS pixel_type, o_totalprice AS intensity
        FROM orders)""",
    "regions": f"""shape(i, dx, dy) AS (VALUES {_corner_sql()}),
    regions AS (
        SELECT 'class_' || cluster::varchar AS region_class, barcode AS region_name, i,
               pxl_col_in_fullres + dx AS x, pxl_row_in_fullres + dy AS y
        FROM spots, shape WHERE score >= 8500),
    edges AS (
        SELECT region_class, region_name, i, x AS x1, y AS y1,
               coalesce(lead(x) OVER w, first_value(x) OVER w) AS x2,
               coalesce(lead(y) OVER w, first_value(y) OVER w) AS y2
        FROM regions
        WINDOW w AS (PARTITION BY region_name ORDER BY i))""",
    "morph": """morph AS (
        SELECT vec_id AS cell_ids, vec_id // 25 AS barcode, embedding::double[] AS features,
               label AS spot_clusters FROM embeddings)""",
    "experiments": """experiments AS (
        SELECT s_suppkey AS barcode, n_regionkey AS exp_id
        FROM supplier JOIN nation ON s_nationkey = n_nationkey)""",
}


def sql(*names: str, body: str, extra: str = "") -> str:
    """An oracle text: the named derivations, extra steps, then the final select."""
    steps = [CTES[name] for name in names]
    if extra:
        steps.append(extra)
    return "WITH RECURSIVE " + ",\n".join(steps) + "\n" + body if steps else body


def normal_tail_sql(z: str) -> str:
    """P(Z > z) for z >= 0 in DuckDB: one half less the density times z + z^3/3 + z^5/(3 * 5) + ...

    Beyond 7 the tail is below 2e-12 and counts as zero.
    """
    step = f"e.t * ({z}) * ({z}) / (2 * k.k + 1)"
    return f"""CASE WHEN {z} > 7 THEN 0.0::double ELSE 0.5 - exp(-({z}) * ({z}) / 2) / sqrt(2 * pi()) * list_reduce(
    list_prepend({{'t': ({z})::double, 's': ({z})::double, 'k': 0.0::double}},
        list_transform(range(1, 150), lambda k: {{'t': 0.0::double, 's': 0.0::double, 'k': k::double}})),
    lambda e, k: {{'t': {step}, 's': e.s + {step}, 'k': k.k}}).s END"""


def student_two_sided_sql(t: str, df: str) -> str:
    """P(|T| > |t|) for whole degrees of freedom in DuckDB, by the finite series in cos^2 of atan(t / sqrt(df))."""
    c2 = f"(({df})::double / (({df}) + ({t}) * ({t})))"
    sine = f"(abs({t}) / sqrt(({df}) + ({t}) * ({t})))"

    def series(factor: str, terms: str) -> str:
        step = f"e.t * {factor} * {c2}"
        return f"""list_reduce(list_prepend({{'t': 1.0::double, 's': 1.0::double, 'k': 0.0::double}},
        list_transform(range(1, {terms}), lambda k: {{'t': 0.0::double, 's': 0.0::double, 'k': k::double}})),
    lambda e, k: {{'t': {step}, 's': e.s + {step}, 'k': k.k}}).s"""

    even = series("(2 * k.k - 1) / (2 * k.k)", f"({df})::bigint // 2")
    odd = series("(2 * k.k) / (2 * k.k + 1)", f"greatest((({df})::bigint - 1) // 2, 1)")
    first = f"CASE WHEN ({df}) > 1 THEN {sine} * sqrt({c2}) * {odd} ELSE 0.0::double END"
    return f"""CASE WHEN ({df})::bigint % 2 = 0 THEN 1 - {sine} * {even}
    ELSE 1 - 2 / pi() * (atan(abs({t}) / sqrt({df})) + {first}) END"""
