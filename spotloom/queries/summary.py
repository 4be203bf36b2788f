"""Summaries of cell types over spots, clusters and the tissue."""

from pyspark.sql import functions as F

from .. import domain as d
from ..functions.numeric import r6
from ..operators import summaries as s
from ..registry import query

TYPES = ["click", "error", "purchase", "signup", "view"]

_COUNTS = "counts AS (SELECT barcode, cell_type, count(*) AS n FROM assigned GROUP BY 1, 2)"
_PSPOT = (
    _COUNTS
    + """,
p_spot AS (SELECT barcode, cell_type, n / sum(n) OVER (PARTITION BY barcode)::double AS p_spot FROM counts),
cl AS (
    SELECT cluster_name, p.cell_type, sum(p_spot) AS s
    FROM assigned a JOIN p_spot p USING (barcode) GROUP BY 1, 2),
p_cluster AS (SELECT cluster_name, cell_type, s / sum(s) OVER (PARTITION BY cluster_name) AS p_cluster FROM cl)"""
)


@query(
    "summary_spot_types",
    d.sql(
        "assigned",
        body="SELECT barcode, "
        + ", ".join(f"count(*) FILTER (WHERE cell_type = '{t}') AS {t}" for t in TYPES)
        + " FROM assigned GROUP BY 1",
    ),
)
def summary_spot_types(spark, sf):
    return s.spot_type_table(d.assigned(spark, sf), TYPES)


@query(
    "summary_spot_statistics",
    d.sql(
        "assigned",
        extra=_COUNTS
        + """,
dense AS (
    SELECT t.cell_type, coalesce(n, 0) AS n
    FROM (SELECT DISTINCT barcode FROM assigned) b CROSS JOIN (SELECT DISTINCT cell_type FROM assigned) t
    LEFT JOIN counts USING (barcode, cell_type))""",
        body="""SELECT cell_type, sum(n)::bigint AS cell_count, round(avg(n), 2) AS avg_spot,
    round(quantile_cont(n, 0.5), 2) AS median_spot, max(n) AS max_spot, min(n) AS min_spot,
    round(stddev_samp(n), 2) AS std_spot, round(quantile_cont(n, 0.9), 2) AS p90_spot,
    round(quantile_cont(n, 0.1), 2) AS p10_spot
FROM dense GROUP BY 1""",
    ),
)
def summary_spot_statistics(spark, sf):
    return s.spot_statistics(d.assigned(spark, sf))


@query(
    "summary_cell_counts",
    d.sql("assigned", body="SELECT cell_type, count(barcode) AS cell_count FROM assigned GROUP BY 1"),
)
def summary_cell_counts(spark, sf):
    return s.cells_per_type(d.assigned(spark, sf))


@query(
    "summary_cells_per_spot_long",
    d.sql(
        "assigned", extra=_COUNTS,
        body="""SELECT b.barcode, t.cell_type, coalesce(n, 0) AS n
FROM (SELECT DISTINCT barcode FROM assigned) b CROSS JOIN (SELECT DISTINCT cell_type FROM assigned) t
LEFT JOIN counts c ON c.barcode = b.barcode AND c.cell_type = t.cell_type""",
    ),
)
def summary_cells_per_spot_long(spark, sf):
    """The wide spot table melted back for plotting."""
    wide = s.spot_type_table(d.assigned(spark, sf), TYPES)
    return wide.unpivot("barcode", TYPES, "cell_type", "n")


@query(
    "summary_spot_probability",
    d.sql(
        "assigned", extra=_PSPOT,
        body="SELECT barcode, cell_type, round(p_spot, 6) AS p_spot FROM p_spot",
    ),
)
def summary_spot_probability(spark, sf):
    p = s.spot_probability(d.assigned(spark, sf))
    return p.withColumn("p_spot", r6(F.col("p_spot")))


@query(
    "summary_cluster_probability",
    d.sql(
        "assigned", extra=_PSPOT,
        body="SELECT cluster_name, cell_type, round(p_cluster, 6) AS p_cluster FROM p_cluster",
    ),
)
def summary_cluster_probability(spark, sf):
    cells = d.assigned(spark, sf)
    p = s.cluster_probability(cells, s.spot_probability(cells))
    return p.withColumn("p_cluster", r6(F.col("p_cluster")))


@query(
    "summary_combined_probability",
    d.sql(
        "assigned",
        extra=_PSPOT
        + """,
present AS (SELECT DISTINCT barcode, cluster_name FROM assigned),
inner_norm AS (
    SELECT barcode, cluster_name, cell_type, p_spot,
           p_cluster / sum(p_cluster) OVER (PARTITION BY barcode, cluster_name) AS q
    FROM present JOIN p_spot USING (barcode) JOIN p_cluster USING (cluster_name, cell_type))""",
        body="""SELECT barcode, cluster_name, cell_type,
    round(p_spot * q / sum(p_spot * q) OVER (PARTITION BY barcode, cluster_name), 6) AS p_combined
FROM inner_norm""",
    ),
)
def summary_combined_probability(spark, sf):
    cells = d.assigned(spark, sf)
    p_spot = s.spot_probability(cells)
    p = s.combined_probability(cells, p_spot, s.cluster_probability(cells, p_spot))
    return p.withColumn("p_combined", r6(F.col("p_combined")))


@query(
    "summary_entropy",
    d.sql(
        "assigned", extra=_COUNTS,
        body="""SELECT barcode, round(-sum(p * ln(p)) + 0, 6) AS shannon_entropy,
    round(CASE WHEN count(*) = 1 THEN -sum(p * ln(p)) ELSE -sum(p * ln(p)) / ln(count(*)) END, 6)
        AS normalized_entropy
FROM (SELECT barcode, n / sum(n) OVER (PARTITION BY barcode)::double AS p FROM counts) GROUP BY 1""",
    ),
)
def summary_entropy(spark, sf):
    e = s.label_entropy(d.assigned(spark, sf), "barcode", "cell_type")
    return e.select(
        "barcode",
        r6(F.col("shannon_entropy")).alias("shannon_entropy"),
        r6(F.col("normalized_entropy")).alias("normalized_entropy"),
    )


@query(
    "summary_id_range",
    d.sql("assigned", body="SELECT min(cell_ids) AS low, max(cell_ids) AS high FROM assigned"),
)
def summary_id_range(spark, sf):
    return d.assigned(spark, sf).agg(F.min("cell_ids").alias("low"), F.max("cell_ids").alias("high"))
