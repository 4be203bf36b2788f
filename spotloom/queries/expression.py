"""Gene-selection queries."""

from pyspark.sql import functions as F

from .. import domain as d
from ..functions.numeric import r6
from ..operators import genes as g
from ..registry import query

_MOMENTS = """ns AS (SELECT count(*)::double AS n FROM spots),
moments AS (
    SELECT gene, sum(count)::bigint AS total, sum(count) / n AS mean,
           (sum(count * count) - sum(count)::double * sum(count) / n) / (n - 1) AS variance
    FROM expr, ns GROUP BY gene, n)"""


def _moments(spark, sf):
    n_spots = d.spots(spark, sf).agg(F.count("*")).scalar()
    return g.gene_moments(d.expr(spark, sf), n_spots)


@query(
    "genes_moments",
    d.sql(
        "expr", "spots", extra=_MOMENTS,
        body="SELECT gene, total, round(mean, 6) AS mean, round(variance, 6) AS variance FROM moments",
    ),
)
def genes_moments(spark, sf):
    m = _moments(spark, sf)
    return m.select("gene", "total", r6(F.col("mean")).alias("mean"), r6(F.col("variance")).alias("variance"))


@query(
    "genes_top_expressed",
    d.sql(
        "expr", "spots", extra=_MOMENTS,
        body="SELECT gene, total FROM moments ORDER BY total DESC, gene LIMIT 20",
    ),
)
def genes_top_expressed(spark, sf):
    return g.top_genes(_moments(spark, sf), 20).select("gene", "total")


@query(
    "genes_top_variable",
    d.sql(
        "expr", "spots", extra=_MOMENTS,
        body="""SELECT gene, round(variance, 6) AS variance FROM moments
ORDER BY moments.variance DESC, gene LIMIT 20""",
    ),
)
def genes_top_variable(spark, sf):
    top = g.top_genes(_moments(spark, sf), 20, "variability")
    return top.select("gene", r6(F.col("variance")).alias("variance"))


@query(
    "genes_top_average",
    d.sql(
        "expr", "spots", extra=_MOMENTS,
        body="SELECT gene, round(mean, 6) AS mean FROM moments ORDER BY total DESC, gene LIMIT 10",
    ),
)
def genes_top_average(spark, sf):
    top = g.top_genes(_moments(spark, sf), 10)
    return top.select("gene", r6(F.col("mean")).alias("mean"))


@query(
    "genes_variance_cap",
    d.sql(
        "expr", "spots", extra=_MOMENTS,
        body="SELECT gene, total FROM moments ORDER BY total DESC, gene LIMIT 3000",
    ),
)
def genes_variance_cap(spark, sf):
    """The most expressed genes that enter the spatial-variability test."""
    return g.top_genes(_moments(spark, sf), 3000).select("gene", "total")


@query(
    "genes_target_union",
    d.sql(
        "expr", "spots", "genes", extra=_MOMENTS,
        body="""SELECT gene FROM genes WHERE brand = 'Brand#7'
UNION (SELECT gene FROM moments ORDER BY total DESC, gene LIMIT 50)
UNION (SELECT gene FROM moments ORDER BY variance DESC, gene LIMIT 50)
ORDER BY gene""",
    ),
)
def genes_target_union(spark, sf):
    wanted = d.genes(spark, sf).filter("brand = 'Brand#7'")
    return g.target_genes(_moments(spark, sf), wanted, 50, 50).orderBy("gene")


@query(
    "genes_name_match",
    d.sql(
        "genes",
        body="""SELECT gene_name FROM genes
WHERE contains(gene_name, 'RED BOLT') OR contains(gene_name, 'LARGE-BLUE')""",
    ),
)
def genes_name_match(spark, sf):
    return g.match_gene_names(d.genes(spark, sf), ["red bolt", "Large-Blue"]).select("gene_name")


@query(
    "genes_name_match_fallback",
    d.sql("genes", body="SELECT gene_name FROM genes ORDER BY gene_name LIMIT 5"),
)
def genes_name_match_fallback(spark, sf):
    return g.match_gene_names(d.genes(spark, sf), ["no such gene"]).select("gene_name")


@query(
    "genes_usable_matrix",
    d.sql(
        "expr",
        body="""SELECT barcode, p_name AS gene_name, sum(count)::bigint AS count
FROM expr JOIN part ON gene = p_partkey WHERE NOT contains(p_name, 'widget') GROUP BY 1, 2""",
    ),
)
def genes_usable_matrix(spark, sf):
    """Deprecated probes out, duplicate names added up (64 names for all genes)."""
    part = d.table(spark, sf, "part")
    name = F.when(F.col("p_name").contains("widget"), F.concat(F.lit("DEPRECATED-"), "p_name"))
    features = part.select(
        F.col("p_partkey").alias("gene"), F.coalesce(name, F.col("p_name")).alias("gene_name")
    )
    return g.drop_unusable_genes(d.expr(spark, sf), features)


@query(
    "genes_reference_filter",
    d.sql(
        "expr", "spots",
        body="""SELECT gene, n_cells, round(m, 6) AS nonzero_mean FROM (
    SELECT gene, count(*) AS n_cells, avg(count) AS m FROM expr GROUP BY 1)
WHERE n_cells > 0.3 * (SELECT count(*) FROM spots) OR (n_cells > 20 AND m > 28)""",
    ),
)
def genes_reference_filter(spark, sf):
    n = d.spots(spark, sf).agg(F.count("*")).scalar()
    kept = g.filter_reference_genes(d.expr(spark, sf), n, 20, 0.3, 28.0)
    return kept.select("gene", "n_cells", r6(F.col("nonzero_mean")).alias("nonzero_mean"))


@query(
    "genes_shared",
    d.sql(
        "expr", "genes",
        body="""SELECT gene FROM expr WHERE gene IN
(SELECT gene FROM genes WHERE brand IN ('Brand#3', 'Brand#4')) GROUP BY 1""",
    ),
)
def genes_shared(spark, sf):
    """Genes of the sample that the reference panel has too."""
    panel = d.genes(spark, sf).filter("brand in ('Brand#3', 'Brand#4')").select("gene")
    return d.expr(spark, sf).select("gene").intersect(panel)


@query(
    "genes_analysable_names",
    d.sql(
        "genes",
        body="""SELECT brand, count(*) FILTER (WHERE upper(replace(gene_name, '-', '_')) =
    replace(gene_name, '-', '_') AND NOT contains(replace(gene_name, '-', '_'), '.')) AS usable,
    count(*) AS all_genes FROM genes GROUP BY 1""",
    ),
)
def genes_analysable_names(spark, sf):
    name = F.regexp_replace("gene_name", "-", "_")
    return d.genes(spark, sf).groupBy("brand").agg(
        F.count_if(g.gene_name_is_analysable(name)).alias("usable"),
        F.count("*").alias("all_genes"),
    )
