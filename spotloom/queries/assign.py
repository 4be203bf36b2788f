"""Cell-type assignment, deconvolution counts and morphology."""

from pyspark.sql import functions as F

from .. import domain as d
from ..functions.numeric import r6
from ..operators import annealing, assignment as a, deconvolution as dc, morphology as mo
from ..operators import summaries as s
from ..operators.merge import NOT_DECONVOLVED
from ..registry import query


@query(
    "deconv_types_present",
    d.sql(
        "deconv",
        body="""SELECT barcode, cell_type, n, count(*) OVER w AS distinct_cell_types,
    (sum(n) OVER w)::bigint AS cell_n FROM deconv WHERE n > 0 WINDOW w AS (PARTITION BY barcode)""",
    ),
)
def deconv_types_present(spark, sf):
    return dc.non_empty_types(d.deconv(spark, sf))


@query(
    "deconv_distribution",
    d.sql(
        "deconv",
        body="""SELECT barcode, cell_type, round(n / sum(n) OVER (PARTITION BY barcode)::double, 6) AS share
FROM deconv WHERE n > 0""",
    ),
)
def deconv_distribution(spark, sf):
    return dc.type_distribution(d.deconv(spark, sf)).withColumn("share", r6(F.col("share")))


_APPORTION = """cells_n AS (SELECT barcode, count(*) AS cell_n FROM assigned GROUP BY 1),
thr AS (SELECT barcode, cell_type, CASE WHEN n < 2 THEN 0 ELSE n END::double AS n FROM deconv),
props AS (
    SELECT barcode, list(p ORDER BY cell_type) AS ps, list(cell_type ORDER BY cell_type) AS ts
    FROM (SELECT barcode, cell_type,
                 CASE WHEN sum(n) OVER w > 0 THEN n / sum(n) OVER w ELSE 0 END AS p
          FROM thr WINDOW w AS (PARTITION BY barcode)) GROUP BY 1),
start AS (SELECT barcode, ps, ts, coalesce(cell_n, 0) AS cell_n FROM props LEFT JOIN cells_n USING (barcode)),
fold(barcode, i, dist) AS (
    SELECT barcode, 0::bigint, list_transform(ps, lambda p: 0.0::double) FROM start
    UNION ALL
    SELECT f.barcode, i + 1, list_transform(dist, lambda c, k: CASE WHEN k = list_position(
        list_transform(ps, lambda p, j: p - dist[j] / greatest(i, 1)),
        list_max(list_transform(ps, lambda p, j: p - dist[j] / greatest(i, 1)))) THEN c + 1 ELSE c END)
    FROM fold f JOIN start s ON s.barcode = f.barcode WHERE i < cell_n)"""


@query(
    "deconv_cell_counts",
    d.sql(
        "deconv", "assigned", extra=_APPORTION,
        body="""SELECT barcode, unnest(ts) AS cell_type, unnest(dist)::bigint AS n
FROM fold JOIN start USING (barcode) WHERE i = cell_n""",
    ),
)
def deconv_cell_counts(spark, sf):
    """Threshold, share and apportion the cells of every spot over its types."""
    abundance = d.deconv(spark, sf).select(
        "barcode", "cell_type", F.col("n").cast("double").alias("abundance")
    )
    cells = d.assigned(spark, sf).groupBy("barcode").agg(F.count("*").alias("cell_n"))
    return dc.counts_from_abundance(abundance, cells, 2)


_NAIVE = """pos AS (
    SELECT *, row_number() OVER (PARTITION BY barcode ORDER BY (cell_ids * 7919) % 10007, cell_ids) AS pos
    FROM assigned),
slots AS (
    SELECT barcode, cell_type, n, sum(n) OVER (PARTITION BY barcode ORDER BY cell_type)::bigint AS upto,
           row_number() OVER (PARTITION BY barcode ORDER BY cell_type) - 1 AS idx
    FROM deconv),
dealt AS (
    SELECT p.cell_ids, p.barcode, p.cluster_name, s.cell_type, s.idx
    FROM pos p LEFT JOIN slots s ON s.barcode = p.barcode AND p.pos <= s.upto AND p.pos > s.upto - s.n)"""


def _naive(spark, sf):
    cells = d.assigned(spark, sf).select("cell_ids", "barcode", "cluster_name")
    order = (F.col("cell_ids") * 7919) % 10007
    return a.naive_assignment(
        cells, d.deconv(spark, sf), order, F.floor(order / 100)
    )


@query(
    "assign_naive",
    d.sql(
        "assigned", "deconv", extra=_NAIVE,
        body="""SELECT cell_ids, barcode, cluster_name, cell_type, idx::int AS spot_clusters FROM dealt""",
    ),
)
def assign_naive(spark, sf):
    return _naive(spark, sf)


_SCORE = """,
typed AS (SELECT * FROM dealt WHERE cell_type IS NOT NULL),
ps AS (
    SELECT barcode, cell_type, count(*) / sum(count(*)) OVER (PARTITION BY barcode)::double AS p_spot
    FROM typed GROUP BY 1, 2),
cl AS (SELECT cluster_name, ps.cell_type, sum(p_spot) AS s FROM dealt JOIN ps USING (barcode) GROUP BY 1, 2),
pc AS (SELECT cluster_name, cell_type, s / sum(s) OVER (PARTITION BY cluster_name) AS p_cluster FROM cl),
comb AS (
    SELECT barcode, cluster_name, cell_type,
           p_spot * p_cluster / sum(p_spot * p_cluster) OVER (PARTITION BY barcode, cluster_name) AS p
    FROM (SELECT DISTINCT barcode, cluster_name FROM dealt) JOIN ps USING (barcode)
    JOIN pc USING (cluster_name, cell_type))"""


def _deconvolved(spark, sf):
    """Cells of spots with types to deal: 'not deconvolved' is no type and has no probability."""
    return _naive(spark, sf).filter(~F.col("cell_type").eqNullSafe(NOT_DECONVOLVED))


def _combined(cells):
    p_spot = s.spot_probability(cells)
    return s.combined_probability(cells, p_spot, s.cluster_probability(cells, p_spot))


@query(
    "assign_allocation_score",
    d.sql(
        "assigned", "deconv", extra=_NAIVE + _SCORE,
        body="""SELECT barcode, round(sum(p), 6) AS score
FROM typed JOIN comb USING (barcode, cluster_name, cell_type) GROUP BY 1""",
    ),
)
def assign_allocation_score(spark, sf):
    cells = _deconvolved(spark, sf)
    scored = a.allocation_score(cells.filter("cell_type is not null"), _combined(cells))
    return scored.withColumn("score", r6(F.col("score")))


@query("assign_global")
def assign_global(spark, sf):
    """Best allocation per spot, with the score before and after."""
    cells = _deconvolved(spark, sf).select("cell_ids", "barcode", "cluster_name", "cell_type")
    combined = _combined(cells)
    best = a.optimal_allocation(cells, combined)
    before = a.allocation_score(cells.filter("cell_type is not null"), combined)
    after = a.allocation_score(best, combined)
    return before.join(after.withColumnRenamed("score", "best_score"), "barcode").select(
        "barcode", r6(F.col("score")).alias("score"), r6(F.col("best_score")).alias("best_score")
    )


@query("assign_local")
def assign_local(spark, sf):
    """Annealing of the morphology vectors within each spot."""
    cells = d.morph(spark, sf).select("cell_ids", "barcode", "features")
    return annealing.local_assignment(cells, d.deconv(spark, sf))


_SIL = """pairs AS (
    SELECT a.cell_ids, a.barcode, a.spot_clusters AS own, b.spot_clusters AS other,
           sum(list_distance(a.features, b.features)) AS total, count(*) AS size
    FROM morph a JOIN morph b ON a.barcode = b.barcode GROUP BY 1, 2, 3, 4),
ab AS (
    SELECT cell_ids, barcode, max(CASE WHEN own = other AND size > 1 THEN total / (size - 1) END) AS a,
           max(CASE WHEN own = other THEN size END) AS own_size,
           min(CASE WHEN own <> other THEN total / size END) AS b
    FROM pairs GROUP BY 1, 2),
grp AS (SELECT barcode, count(*) AS n, count(DISTINCT spot_clusters) AS k FROM morph GROUP BY 1),
sil AS (
    SELECT cell_ids, barcode, CASE WHEN k = 1 OR k = n THEN 1.0 WHEN own_size = 1 THEN 0.0
        ELSE (b - a) / greatest(a, b) END::double AS sil_score
    FROM ab JOIN grp USING (barcode)),
ent AS (
    SELECT barcode, CASE WHEN count(*) = 1 THEN 0 ELSE -sum(p * ln(p)) / ln(count(*)) END AS h FROM (
        SELECT barcode, count(*) / sum(count(*)) OVER (PARTITION BY barcode)::double AS p
        FROM morph GROUP BY barcode, spot_clusters) GROUP BY 1)"""


@query(
    "assign_silhouette",
    d.sql("morph", extra=_SIL, body="SELECT cell_ids, barcode, round(sil_score, 6) AS sil_score FROM sil"),
)
def assign_silhouette(spark, sf):
    scored = a.silhouette(d.morph(spark, sf))
    return scored.select("cell_ids", "barcode", r6(F.col("sil_score")).alias("sil_score"))


@query(
    "assign_confidence",
    d.sql(
        "morph", extra=_SIL,
        body="""SELECT cell_ids, barcode, round(sil_score, 6) AS sil_score, round(h, 6) AS normalized_entropy,
    round(sil_score * (1 - h), 6) AS confidence_score FROM sil JOIN ent USING (barcode)""",
    ),
)
def assign_confidence(spark, sf):
    scored = a.confidence(d.morph(spark, sf))
    return scored.select(
        "cell_ids", "barcode",
        *[r6(F.col(c)).alias(c) for c in ("sil_score", "normalized_entropy", "confidence_score")],
    )


@query(
    "morph_standardised",
    d.sql(
        "morph",
        extra="""flat AS (SELECT cell_ids, unnest(features) AS v, generate_subscripts(features, 1) AS i FROM morph),
st AS (SELECT i, avg(v) AS m, stddev_pop(v) AS s FROM flat GROUP BY 1)""",
        body="SELECT cell_ids, (i - 1)::int AS feature, round((v - m) / s, 6) AS z FROM flat JOIN st USING (i)",
    ),
)
def morph_standardised(spark, sf):
    scaled = mo.standardise(d.morph(spark, sf))
    return scored_long(scaled)


def scored_long(scaled):
    return scaled.select("cell_ids", F.posexplode("features").alias("feature", "v")).select(
        "cell_ids", "feature", r6(F.col("v")).alias("z")
    )


@query("morph_principal_components")
def morph_principal_components(spark, sf):
    reduced = mo.reduce(mo.standardise(d.morph(spark, sf)), 10)
    return reduced.select("cell_ids", "features")


@query("morph_clusters_gaussian")
def morph_clusters_gaussian(spark, sf):
    reduced = mo.reduce(mo.standardise(d.morph(spark, sf)), 10)
    return mo.cluster(reduced, "gaussian", 5).select("cell_ids", "clusters")


@query("morph_clusters_kmeans")
def morph_clusters_kmeans(spark, sf):
    reduced = mo.reduce(mo.standardise(d.morph(spark, sf)), 10)
    return mo.cluster(reduced, "kmeans", 20).select("cell_ids", "clusters")
