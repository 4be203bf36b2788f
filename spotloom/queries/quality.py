"""Quality-metric queries."""

from pyspark.sql import functions as F

from .. import domain as d
from ..functions.numeric import r6
from ..operators import qc
from ..registry import query

PREFIXES = ["promo"]
MEMBERS = ["SMALL-RED WIDGET-1"]
FLAG_SQL = "(starts_with(upper(gene_name), 'PROMO') OR gene_name IN ('SMALL-RED WIDGET-1'))"

_SIZES = """sizes AS (
    SELECT (SELECT count(DISTINCT gene) FROM expr)::double AS n_genes,
           (SELECT count(*) FROM spots)::double AS n_spots,
           (SELECT sum(count) FROM expr)::double AS total),
contained AS (
    SELECT barcode, count(*) AS num_contained_cells FROM assigned GROUP BY 1)"""


def _spots(spark, sf):
    """Spots with the number of cells that name them."""
    cells = d.assigned(spark, sf).groupBy("barcode").agg(F.count("*").alias("num_contained_cells"))
    return d.spots(spark, sf).join(cells, "barcode", "left").na.fill(0, ["num_contained_cells"])


@query(
    "qc_spot",
    d.sql(
        "expr", "spots", "genes", "assigned",
        extra=_SIZES
        + f""",
per_spot AS (
    SELECT barcode, count(*) AS umi, sum(count)::bigint AS cts,
           count(*) FILTER (WHERE {FLAG_SQL}) AS art_n,
           coalesce(sum(count) FILTER (WHERE {FLAG_SQL}), 0)::bigint AS art_cts
    FROM expr LEFT JOIN genes USING (gene) GROUP BY 1),
m AS (
    SELECT s.*, coalesce(umi, 0) AS umi, coalesce(cts, 0) AS cts, coalesce(art_n, 0) AS art_n,
           coalesce(art_cts, 0) AS art_cts, coalesce(num_contained_cells, 0) AS nc
    FROM spots s LEFT JOIN per_spot USING (barcode) LEFT JOIN contained USING (barcode)
    WHERE in_tissue = 1)""",
        body="""SELECT barcode, in_tissue, pxl_row_in_fullres, pxl_col_in_fullres,
    nc AS qc_num_contained_cells, art_n AS qc_mitochondrial_genes_n,
    art_cts AS qc_mitochondrial_genes_cts, umi AS "qc_nGenes",
    round_even(umi / n_genes, 3) AS "qc_nGenes_prop", cts AS "qc_nCounts",
    round(cts / total, 6) AS "qc_nCounts_prop",
    round_even(cts::double / nullif(umi, 0), 3) AS "qc_CountByGene",
    round_even((1 - umi / nullif(cts, 0)::double) * (umi / n_genes), 3) AS "qc_GeneSaturation"
FROM m, sizes""",
    ),
)
def qc_spot(spark, sf):
    result = qc.spot_qc(
        d.expr(spark, sf), _spots(spark, sf), d.genes(spark, sf), PREFIXES, MEMBERS
    )
    return result.withColumn("qc_nCounts_prop", r6(F.col("qc_nCounts_prop")))


@query(
    "qc_gene",
    d.sql(
        "expr", "spots", "genes", "assigned",
        extra=_SIZES,
        body=f"""SELECT gene, {FLAG_SQL} AS qc_mitochondrial_genes, umi AS "qc_nSpots",
    round_even(umi / n_spots, 3) AS "qc_nSpots_prop", cts AS "qc_nCounts",
    round(cts / total, 6) AS "qc_nCounts_prop",
    round_even(cts::double / nullif(umi, 0), 3) AS "qc_CountsBySpot",
    round_even((1 - umi / nullif(cts, 0)::double) * (umi / n_spots), 3) AS "qc_SpotSaturation"
FROM (SELECT gene, count(*) AS umi, sum(count)::bigint AS cts FROM expr GROUP BY 1)
LEFT JOIN genes USING (gene), sizes""",
    ),
)
def qc_gene(spark, sf):
    result = qc.gene_qc(
        d.expr(spark, sf), _spots(spark, sf), d.genes(spark, sf), PREFIXES, MEMBERS
    )
    return result.withColumn("qc_nCounts_prop", r6(F.col("qc_nCounts_prop")))


@query(
    "qc_overall",
    d.sql(
        "expr",
        body="""SELECT 'sample' AS exp_id, count(*) AS "qc_detected_Probes",
    sum(count)::bigint AS "qc_Library_size",
    round_even(sum(count)::double / count(*), 3) AS "qc_CountByProbes",
    round_even(1 - count(*) / sum(count)::double, 3) AS "qc_Saturation"
FROM expr""",
    ),
)
def qc_overall(spark, sf):
    return qc.overall_qc(d.expr(spark, sf), "sample")


@query(
    "qc_overall_by_sample",
    d.sql(
        "expr", "experiments",
        body="""SELECT exp_id, count(*) AS "qc_detected_Probes",
    sum(count)::bigint AS "qc_Library_size",
    round_even(sum(count)::double / count(*), 3) AS "qc_CountByProbes",
    round_even(1 - count(*) / sum(count)::double, 3) AS "qc_Saturation"
FROM expr JOIN experiments USING (barcode) GROUP BY exp_id""",
    ),
)
def qc_overall_by_sample(spark, sf):
    return qc.overall_qc_by_sample(d.expr(spark, sf), d.experiments(spark, sf))


@query(
    "qc_gene_artifacts",
    d.sql(
        "expr", "genes",
        body=f"""SELECT barcode, count(*) FILTER (WHERE {FLAG_SQL}) AS artifact_n,
    coalesce(sum(count) FILTER (WHERE {FLAG_SQL}), 0)::bigint AS artifact_cts
FROM expr LEFT JOIN genes USING (gene) GROUP BY 1""",
    ),
)
def qc_gene_artifacts(spark, sf):
    flag = qc.gene_group(F.col("gene_name"), PREFIXES, MEMBERS)
    flagged = d.genes(spark, sf).filter(flag).select("gene", F.lit(True).alias("hit"))
    return (
        d.expr(spark, sf)
        .join(flagged, "gene", "left")
        .groupBy("barcode")
        .agg(
            F.count("hit").alias("artifact_n"),
            F.sum(F.when(F.col("hit"), F.col("count")).otherwise(0)).alias("artifact_cts"),
        )
    )


@query(
    "qc_gene_group_mask",
    d.sql("genes", body=f"SELECT gene, {FLAG_SQL} AS mask FROM genes"),
)
def qc_gene_group_mask(spark, sf):
    return d.genes(spark, sf).select(
        "gene", qc.gene_group(F.col("gene_name"), PREFIXES, MEMBERS).alias("mask")
    )


@query(
    "qc_in_tissue_filter",
    d.sql(
        "spots",
        body="SELECT barcode, array_row, array_col FROM spots WHERE in_tissue = 1",
    ),
)
def qc_in_tissue_filter(spark, sf):
    return d.spots(spark, sf).filter("in_tissue = 1").select("barcode", "array_row", "array_col")


@query(
    "qc_non_empty_spots",
    d.sql(
        "spots", "assigned",
        body="""SELECT barcode, count(*) AS num_contained_cells FROM assigned
JOIN spots USING (barcode) WHERE in_tissue = 1 GROUP BY 1""",
    ),
)
def qc_non_empty_spots(spark, sf):
    return (
        _spots(spark, sf)
        .filter("in_tissue = 1 and num_contained_cells > 0")
        .select("barcode", "num_contained_cells")
    )


@query(
    "qc_renamed_metrics",
    d.sql(
        "expr",
        body="""SELECT barcode, count(*) AS detected FROM expr GROUP BY 1""",
    ),
)
def qc_renamed_metrics(spark, sf):
    raw = d.expr(spark, sf).groupBy("barcode").agg(
        F.count("*").alias("UMI"), F.sum("count").alias("UMI_cts")
    )
    return qc.rename_metrics(raw, {"UMI": "detected", "UMI_cts": None})
