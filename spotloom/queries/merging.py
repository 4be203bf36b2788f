"""Joins, reshaping and text formatting of merged tables."""

from pyspark.sql import functions as F

from .. import domain as d
from ..functions.numeric import r6
from ..operators import merge as m
from ..registry import query

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
_P = ", ".join(f"'{p}'" for p in PRIORITIES)


def _wide_sql(value: str, table: str) -> str:
    return ", ".join(
        f"coalesce(sum({value}) FILTER (WHERE cell_type = '{p}'), 0)::double AS \"{p}\""
        for p in PRIORITIES
    )


@query(
    "merge_proportions",
    d.sql(
        "deconv",
        body="""SELECT barcode, cell_type, n,
    round(n / sum(n) OVER (PARTITION BY barcode)::double, 6) AS proportion FROM deconv""",
    ),
)
def merge_proportions(spark, sf):
    p = m.proportions(d.deconv(spark, sf))
    return p.withColumn("proportion", r6(F.col("proportion")))


@query(
    "merge_wide_proportions",
    d.sql(
        "deconv",
        extra="""p AS (SELECT *, round(n / sum(n) OVER (PARTITION BY barcode)::double, 6) AS v FROM deconv)""",
        body=f"SELECT barcode, {_wide_sql('v', 'p')} FROM p GROUP BY 1",
    ),
)
def merge_wide_proportions(spark, sf):
    p = m.proportions(d.deconv(spark, sf)).withColumn("proportion", r6(F.col("proportion")))
    return m.wide_types(p, PRIORITIES, "proportion")


@query(
    "merge_piechart_text",
    d.sql(
        "deconv",
        extra="""p AS (SELECT *, n / sum(n) OVER (PARTITION BY barcode)::double AS v FROM deconv),
w AS (SELECT barcode, unnest([%s]) AS t, unnest([%s]) AS k FROM p GROUP BY barcode)"""
        % (_P, ", ".join(str(i) for i in range(5))),
        body="""SELECT w.barcode, string_agg(round_even(coalesce(v, 0), 2)::varchar, ';' ORDER BY k) AS pie
FROM w LEFT JOIN p ON p.barcode = w.barcode AND p.cell_type = w.t GROUP BY 1""",
    ),
)
def merge_piechart_text(spark, sf):
    return m.piechart_strings(m.proportions(d.deconv(spark, sf)), PRIORITIES)


@query(
    "merge_reindex_spots",
    d.sql(
        "spots", "deconv",
        body=f"""SELECT s.barcode, {_wide_sql('n', 'deconv')}
FROM spots s LEFT JOIN deconv USING (barcode) WHERE in_tissue = 1 GROUP BY 1""",
    ),
)
def merge_reindex_spots(spark, sf):
    spine = d.spots(spark, sf).filter("in_tissue = 1")
    n = d.deconv(spark, sf).withColumn("n", F.col("n").cast("double"))
    return m.reindex_to_spine(spine, m.wide_types(n, PRIORITIES, "n"), "barcode", PRIORITIES)


@query(
    "merge_reindex_report",
    d.sql(
        "spots", "deconv",
        body="""SELECT
    (SELECT count(*) FROM spots WHERE in_tissue = 1 AND barcode NOT IN (SELECT barcode FROM deconv)) AS added,
    (SELECT count(DISTINCT barcode) FROM deconv
     WHERE barcode NOT IN (SELECT barcode FROM spots WHERE in_tissue = 1)) AS dropped""",
    ),
)
def merge_reindex_report(spark, sf):
    return m.reindex_report(
        d.spots(spark, sf).filter("in_tissue = 1"), d.deconv(spark, sf), "barcode"
    )


@query(
    "merge_spots",
    d.sql(
        "spots", "expr", "deconv", "assigned",
        body="""SELECT s.barcode, pxl_row_in_fullres, pxl_col_in_fullres, cluster AS graphical_clustering,
    coalesce(nc, 0) AS num_contained_cells, coalesce(umi, 0) AS "qc_nGenes", dc AS deconv_cell_counts
FROM spots s
LEFT JOIN (SELECT barcode, count(*) AS nc FROM assigned GROUP BY 1) USING (barcode)
LEFT JOIN (SELECT barcode, count(*) AS umi FROM expr GROUP BY 1) USING (barcode)
LEFT JOIN (SELECT barcode, sum(n)::bigint AS dc FROM deconv GROUP BY 1) USING (barcode)
WHERE in_tissue = 1""",
    ),
)
def merge_spots(spark, sf):
    spine = d.spots(spark, sf).filter("in_tissue = 1").select(
        "barcode", "pxl_row_in_fullres", "pxl_col_in_fullres",
        F.col("cluster").alias("graphical_clustering"),
    )
    contained = d.assigned(spark, sf).groupBy("barcode").agg(F.count("*").alias("num_contained_cells"))
    quality = d.expr(spark, sf).groupBy("barcode").agg(F.count("*").alias("qc_nGenes"))
    cells = d.deconv(spark, sf).groupBy("barcode").agg(F.sum("n").alias("deconv_cell_counts"))
    merged = m.merge_on("barcode", spine, contained, quality, None, cells)
    return merged.na.fill(0, ["num_contained_cells", "qc_nGenes"])


@query(
    "merge_cells",
    d.sql(
        "cells", "morph",
        body="""SELECT cell_ids, cell_x, cell_y, 'cluster ' || spot_clusters::varchar AS morphological_cluster,
    coalesce(CASE WHEN spot_clusters < 8 THEN cell_type END, 'not deconvolved') AS cell_type
FROM cells LEFT JOIN morph USING (cell_ids)""",
    ),
)
def merge_cells(spark, sf):
    clusters = d.morph(spark, sf).select("cell_ids", "spot_clusters")
    merged = m.merge_on("cell_ids", d.cells(spark, sf), clusters)
    kept = F.when(F.col("spot_clusters") < 8, F.col("cell_type"))
    return merged.select(
        "cell_ids", "cell_x", "cell_y",
        F.concat(F.lit("cluster "), F.col("spot_clusters").cast("string")).alias("morphological_cluster"),
        m.fill_cell_type(kept).alias("cell_type"),
    )


@query(
    "merge_outer",
    d.sql(
        "spots", "deconv",
        body="""SELECT barcode, cluster, deconv_types FROM spots
FULL JOIN (SELECT barcode, count(*) AS deconv_types FROM deconv GROUP BY 1) USING (barcode)""",
    ),
)
def merge_outer(spark, sf):
    types = d.deconv(spark, sf).groupBy("barcode").agg(F.count("*").alias("deconv_types"))
    return m.merge_on("barcode", d.spots(spark, sf).select("barcode", "cluster"), types, how="full")


@query(
    "merge_keep_deconvolved",
    d.sql(
        "assigned",
        body="SELECT cell_ids, cell_type FROM assigned WHERE cell_type NOT IN ('error', 'view')",
    ),
)
def merge_keep_deconvolved(spark, sf):
    kind = F.col("cell_type")
    relabelled = d.assigned(spark, sf).withColumn(
        "cell_type",
        F.when(kind == "error", m.NOT_DECONVOLVED).when(kind == "view", "Undefined").otherwise(kind),
    )
    return m.keep_deconvolved(relabelled).select("cell_ids", "cell_type")


@query(
    "merge_normal_labels",
    d.sql(
        "deconv",
        body="""SELECT cell_type, lower(replace(replace(cell_type, ' ', '-'), ',', '')) AS label,
    count(*) AS spots FROM deconv GROUP BY 1""",
    ),
)
def merge_normal_labels(spark, sf):
    return (
        d.deconv(spark, sf)
        .groupBy("cell_type")
        .agg(F.count("*").alias("spots"))
        .withColumn("label", m.normalise_label(F.col("cell_type")))
    )


@query(
    "merge_clusterings",
    d.sql(
        "spots",
        body="""SELECT coalesce(a.barcode, b.barcode) AS barcode, a.l AS kmeans_5, b.l AS kmeans_3
FROM (SELECT barcode, cluster::varchar || ' (Gene cluster)' AS l FROM spots WHERE in_tissue = 1) a
FULL JOIN (SELECT barcode, (array_row % 3)::varchar || ' (Gene cluster)' AS l FROM spots WHERE score > 500) b
ON a.barcode = b.barcode""",
    ),
)
def merge_clusterings(spark, sf):
    s = d.spots(spark, sf)
    return m.tag_clusterings(
        {
            "kmeans_5": s.filter("in_tissue = 1").select("barcode", "cluster"),
            "kmeans_3": s.filter("score > 500").select("barcode", F.expr("array_row % 3")),
        }
    )


@query(
    "merge_gene_index",
    d.sql(
        "expr", "genes",
        body="""SELECT gene, gene_name, total FROM (SELECT DISTINCT gene FROM expr)
LEFT JOIN genes USING (gene)
LEFT JOIN (SELECT gene, sum(count)::bigint AS total FROM expr GROUP BY 1) USING (gene)""",
    ),
)
def merge_gene_index(spark, sf):
    totals = d.expr(spark, sf).groupBy("gene").agg(F.sum("count").alias("total"))
    return totals.join(m.keep_first(d.genes(spark, sf).drop("brand"), ["gene"], [F.col("gene_name")]), "gene", "left")


@query(
    "merge_keep_first",
    d.sql(
        "deconv",
        body="""SELECT barcode, cell_type, n FROM deconv
QUALIFY row_number() OVER (PARTITION BY barcode ORDER BY n DESC, cell_type) = 1""",
    ),
)
def merge_keep_first(spark, sf):
    return m.keep_first(d.deconv(spark, sf), ["barcode"], [-F.col("n"), F.col("cell_type")])


@query(
    "merge_aligned_ids",
    d.sql(
        "assigned", "morph",
        body="""SELECT a.cell_ids, b.barcode FROM (
    SELECT cell_ids + greatest((SELECT min(cell_ids) + 3 FROM assigned) - (SELECT min(cell_ids) FROM morph), 0)
        AS cell_ids FROM morph) a
LEFT JOIN (SELECT cell_ids + 3 AS cell_ids, barcode FROM assigned) b USING (cell_ids)""",
    ),
)
def merge_aligned_ids(spark, sf):
    spots = d.assigned(spark, sf).select((F.col("cell_ids") + 3).alias("cell_ids"), "barcode")
    features = d.morph(spark, sf).select("cell_ids")
    return m.align_ids(features, spots, "cell_ids").join(spots, "cell_ids", "left")


@query(
    "merge_semi_cluster_cells",
    d.sql(
        "spots", "assigned",
        body="""SELECT cell_ids, barcode FROM assigned
WHERE barcode IN (SELECT barcode FROM spots WHERE cluster = 2)""",
    ),
)
def merge_semi_cluster_cells(spark, sf):
    members = d.spots(spark, sf).filter("cluster = 2")
    return d.assigned(spark, sf).join(members, "barcode", "left_semi").select("cell_ids", "barcode")


@query(
    "merge_spot_set_difference",
    d.sql(
        "spots", "deconv",
        body="""SELECT barcode FROM deconv EXCEPT SELECT barcode FROM spots WHERE in_tissue = 1""",
    ),
)
def merge_spot_set_difference(spark, sf):
    return d.deconv(spark, sf).select("barcode").subtract(
        d.spots(spark, sf).filter("in_tissue = 1").select("barcode")
    )


@query(
    "merge_append_regions",
    d.sql(
        "spots",
        body="""SELECT 'high' AS region, barcode, cluster FROM spots WHERE score > 5000
UNION ALL SELECT 'tissue', barcode, cluster FROM spots WHERE in_tissue = 1""",
    ),
)
def merge_append_regions(spark, sf):
    s = d.spots(spark, sf)
    high = s.filter("score > 5000").select(F.lit("high").alias("region"), "barcode", "cluster")
    tissue = s.filter("in_tissue = 1").select("cluster", "barcode", F.lit("tissue").alias("region"))
    return high.unionByName(tissue)


@query(
    "merge_one_hot_types",
    d.sql(
        "assigned",
        body="""SELECT cell_ids, (cell_type = 'click')::int AS click, (cell_type = 'error')::int AS error,
    (cell_type = 'purchase')::int AS purchase, (cell_type = 'signup')::int AS signup,
    (cell_type = 'view')::int AS view FROM assigned""",
    ),
)
def merge_one_hot_types(spark, sf):
    types = ["click", "error", "purchase", "signup", "view"]
    return d.assigned(spark, sf).select(
        "cell_ids", *[(F.col("cell_type") == t).cast("int").alias(t) for t in types]
    )


@query(
    "merge_threshold_abundance",
    d.sql(
        "deconv",
        body="""SELECT barcode, cell_type, CASE WHEN n < 2 THEN 0 ELSE n END AS n FROM deconv""",
    ),
)
def merge_threshold_abundance(spark, sf):
    from ..operators.deconvolution import threshold_abundance

    return threshold_abundance(d.deconv(spark, sf), 2)


@query(
    "merge_parameters",
    d.sql(
        body="""SELECT json_extract_string(props, '$.k')::int AS k, count(*) AS n, max(value) AS top
FROM events GROUP BY 1""",
    ),
)
def merge_parameters(spark, sf):
    """Parameters travel as a map; one entry is looked up per row."""
    params = F.from_json("props", "map<string,int>")
    return (
        d.table(spark, sf, "events")
        .select(params["k"].alias("k"), "value")
        .groupBy("k")
        .agg(F.count("*").alias("n"), F.max("value").alias("top"))
    )
