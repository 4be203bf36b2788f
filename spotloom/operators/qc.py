"""Quality metrics per spot, per gene and per sample on a sparse count table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import half_even, ratio

# Output names of the metrics at each level.
SPOT_LABELS = {
    "UMI": "qc_nGenes",
    "UMI_prop": "qc_nGenes_prop",
    "UMI_cts": "qc_nCounts",
    "UMI_cts_prop": "qc_nCounts_prop",
    "cts_by_UMI": "qc_CountByGene",
    "Saturation": "qc_GeneSaturation",
}
GENE_LABELS = {
    "UMI": "qc_nSpots",
    "UMI_prop": "qc_nSpots_prop",
    "UMI_cts": "qc_nCounts",
    "UMI_cts_prop": "qc_nCounts_prop",
    "cts_by_UMI": "qc_CountsBySpot",
    "Saturation": "qc_SpotSaturation",
}
OVERALL_LABELS = {
    "UMI": "qc_detected_Probes",
    "UMI_cts": "qc_Library_size",
    "cts_by_UMI": "qc_CountByProbes",
    "Saturation": "qc_Saturation",
}


def rename_metrics(df: DataFrame, labels: Mapping[str, str | None]) -> DataFrame:
    """Rename by a map; a metric without a name is dropped."""
    unnamed = [old for old, new in labels.items() if new is None]
    return df.drop(*unnamed).withColumnsRenamed({o: n for o, n in labels.items() if n})


def gene_group(name: Column, prefixes: Sequence[str] = (), members: Sequence[str] = ()) -> Column:
    """True for genes with one of the prefixes (any case) or in the list."""
    test = F.lit(False)
    for prefix in prefixes:
        test = test | F.upper(name).startswith(prefix.upper())
    if members:
        test = test | name.isin(list(members))
    return test


def axis_metrics(
    expr: DataFrame,
    axis: str,
    axis_size: Column,
    grand_total: Column,
    spine: DataFrame | None = None,
    flag: Column | None = None,
    flag_label: str = "artifact",
) -> DataFrame:
    """The six metrics for each value of ``axis`` ('barcode' or 'gene').

    ``axis_size`` is the length of the other axis. Entries of ``spine`` without any
    count get zeros and NULL ratios. ``flag`` marks artifact genes; their number
    and counts come out of the same aggregation.
    """
    aggs = [F.count("*").alias("UMI"), F.sum("count").alias("UMI_cts")]
    if flag is not None:
        aggs += [
            F.count_if(flag).alias(f"{flag_label}_n"),
            F.sum(F.when(flag, F.col("count")).otherwise(0)).alias(f"{flag_label}_cts"),
        ]
    grouped = expr.groupBy(axis).agg(*aggs)
    if spine is not None:
        counts = [c for c in grouped.columns if c != axis]
        grouped = spine.join(grouped, axis, "left").na.fill(0, counts)
    umi, cts = F.col("UMI"), F.col("UMI_cts")
    share = umi / axis_size.cast("double")
    return grouped.select(
        *[c for c in grouped.columns if c not in ("UMI", "UMI_cts")],
        umi,
        half_even(share, 3).alias("UMI_prop"),
        cts,
        ratio(cts, grand_total).alias("UMI_cts_prop"),
        half_even(ratio(cts, umi), 3).alias("cts_by_UMI"),
        half_even((1 - ratio(umi, cts)) * share, 3).alias("Saturation"),
    )


def axis_sizes(expr: DataFrame, spots: DataFrame) -> tuple[Column, Column, Column]:
    """(number of detected genes, number of spots, all counts) as scalar subqueries."""
    totals = expr.groupBy("gene").agg(F.sum("count").alias("t")).filter("t > 0")
    return (
        totals.agg(F.count("*")).scalar(),
        spots.agg(F.count("*")).scalar(),
        expr.agg(F.sum("count")).scalar(),
    )


def spot_qc(
    expr: DataFrame,
    spots: DataFrame,
    genes: DataFrame,
    prefixes: Sequence[str],
    members: Sequence[str] = (),
    label: str = "qc_mitochondrial_genes",
) -> DataFrame:
    """Spot metrics, artifact counts and contained cells for in-tissue spots."""
    n_genes, _, total = axis_sizes(expr, spots)
    flagged = genes.filter(gene_group(F.col("gene_name"), prefixes, members)).select(
        "gene", F.lit(True).alias("_artifact")
    )
    marked = expr.join(flagged, "gene", "left")
    spine = spots.filter("in_tissue = 1").select(
        "barcode",
        "in_tissue",
        "pxl_row_in_fullres",
        "pxl_col_in_fullres",
        F.col("num_contained_cells").alias("qc_num_contained_cells"),
    )
    flag = F.coalesce(F.col("_artifact"), F.lit(False))
    metrics = axis_metrics(marked, "barcode", n_genes, total, spine, flag, label)
    return rename_metrics(metrics, SPOT_LABELS)


def gene_qc(
    expr: DataFrame,
    spots: DataFrame,
    genes: DataFrame,
    prefixes: Sequence[str],
    members: Sequence[str] = (),
    label: str = "qc_mitochondrial_genes",
) -> DataFrame:
    _, n_spots, total = axis_sizes(expr, spots)
    names = genes.select("gene", gene_group(F.col("gene_name"), prefixes, members).alias(label))
    metrics = axis_metrics(expr, "gene", n_spots, total).join(names, "gene", "left")
    return rename_metrics(metrics, GENE_LABELS)


def overall_qc(expr: DataFrame, exp_id: str | int) -> DataFrame:
    """One row; the saturation here carries no proportion factor."""
    grouped = expr.agg(F.count("*").alias("UMI"), F.sum("count").alias("UMI_cts"))
    metrics = grouped.select(
        F.lit(exp_id).alias("exp_id"),
        "UMI",
        "UMI_cts",
        half_even(ratio(F.col("UMI_cts"), F.col("UMI")), 3).alias("cts_by_UMI"),
        half_even(1 - ratio(F.col("UMI"), F.col("UMI_cts")), 3).alias("Saturation"),
    )
    return rename_metrics(metrics, OVERALL_LABELS)


def overall_qc_by_sample(expr: DataFrame, samples: DataFrame) -> DataFrame:
    """The overall metrics of many samples in one aggregation.

    Counts are folded per spot before the sample is looked up, so a sample that
    holds most of the data does not put its rows on one task.
    """
    per_spot = expr.groupBy("barcode").agg(F.count("*").alias("u"), F.sum("count").alias("c"))
    grouped = (
        per_spot.join(samples, "barcode")
        .groupBy("exp_id")
        .agg(F.sum("u").alias("UMI"), F.sum("c").alias("UMI_cts"))
    )
    metrics = grouped.select(
        "exp_id",
        "UMI",
        "UMI_cts",
        half_even(ratio(F.col("UMI_cts"), F.col("UMI")), 3).alias("cts_by_UMI"),
        half_even(1 - ratio(F.col("UMI"), F.col("UMI_cts")), 3).alias("Saturation"),
    )
    return rename_metrics(metrics, OVERALL_LABELS)
