"""Neighbour graphs, autocorrelation and co-occurrence."""

from pyspark.sql import functions as F

from .. import domain as d
from ..functions.numeric import r6
from ..operators import cooccurrence as co
from ..operators import graph as g
from ..operators import merge as m
from ..registry import query
from ..session import cut_lineage


_EDGES = """sp AS (SELECT * FROM spots WHERE in_tissue = 1),
ring1 AS (
    SELECT a.barcode AS src, b.barcode AS dst FROM sp a JOIN sp b
    ON (a.array_row = b.array_row AND abs(a.array_col - b.array_col) = 2)
    OR (abs(a.array_row - b.array_row) = 1 AND abs(a.array_col - b.array_col) = 1)),
links AS (
    SELECT src, dst, min(ring)::int AS ring FROM (
        SELECT src, dst, 1 AS ring FROM ring1
        UNION ALL SELECT a.src, b.dst, 2 FROM ring1 a JOIN ring1 b ON a.dst = b.src WHERE a.src <> b.dst)
    GROUP BY 1, 2),
deg AS (SELECT src, count(*) AS degree FROM links GROUP BY 1)"""


def _spots(spark, sf):
    return d.spots(spark, sf).filter("in_tissue = 1")


def _edges(spark, sf):
    return g.lattice_edges(_spots(spark, sf), 2)


@query(
    "graph_lattice_edges",
    d.sql("spots", extra=_EDGES, body="SELECT src, dst, ring FROM links"),
)
def graph_lattice_edges(spark, sf):
    return _edges(spark, sf)


@query("graph_degrees", d.sql("spots", extra=_EDGES, body="SELECT src, degree FROM deg"))
def graph_degrees(spark, sf):
    return g.degrees(_edges(spark, sf))


@query(
    "graph_edge_types",
    d.sql(
        "spots", extra=_EDGES,
        body="""SELECT a.cluster AS type_a, b.cluster AS type_b, count(*) AS n
FROM links JOIN sp a ON src = a.barcode JOIN sp b ON dst = b.barcode GROUP BY 1, 2""",
    ),
)
def graph_edge_types(spark, sf):
    labels = _spots(spark, sf).select(F.col("barcode").alias("id"), F.col("cluster").alias("label"))
    return g.edge_type_counts(_edges(spark, sf), labels)


_ENRICH = """,
gm AS (SELECT sum(degree) / 2 AS e, sum(degree * (degree - 1))::double AS dd FROM deg),
sz AS (SELECT cluster, count(*)::double AS k FROM sp GROUP BY 1),
nn AS (SELECT count(*)::double AS n FROM sp),
seen AS (
    SELECT a.cluster AS type_a, b.cluster AS type_b, count(*) AS n_edges
    FROM links JOIN sp a ON src = a.barcode JOIN sp b ON dst = b.barcode GROUP BY 1, 2),
mat AS (
    SELECT a.cluster AS type_a, b.cluster AS type_b, a.k AS ka, b.k AS kb, n, e, dd,
           coalesce(n_edges, 0) AS n_edges
    FROM sz a CROSS JOIN sz b CROSS JOIN nn CROSS JOIN gm
    LEFT JOIN seen ON seen.type_a = a.cluster AND seen.type_b = b.cluster),
probs AS (
    SELECT *,
        CASE WHEN type_a = type_b THEN ka * (ka - 1) ELSE 2 * ka * kb END / (n * (n - 1)) AS p1,
        CASE WHEN type_a = type_b THEN ka * (ka - 1) * (ka - 2) ELSE ka * kb * (ka + kb - 2) END
            / (n * (n - 1) * (n - 2)) AS p2,
        CASE WHEN type_a = type_b THEN ka * (ka - 1) * (ka - 2) * (ka - 3)
             ELSE 4 * ka * (ka - 1) * kb * (kb - 1) END / (n * (n - 1) * (n - 2) * (n - 3)) AS p3
    FROM mat),
vars AS (SELECT *, e * p1 + dd * p2 + (e * (e - 1) - dd) * p3 - e * p1 * e * p1 AS var FROM probs),
raw_scores AS (
    SELECT type_a, type_b, n_edges,
        (CASE WHEN type_a = type_b THEN n_edges / 2 ELSE n_edges END - e * p1)
        / sqrt(CASE WHEN var > 0 THEN var END) AS zscore
    FROM vars),
scores AS (
    SELECT type_a, type_b, n_edges, coalesce(zscore, min(zscore) OVER ()) AS zscore FROM raw_scores)"""


def _enrichment(spark, sf):
    labels = _spots(spark, sf).select(F.col("barcode").alias("id"), F.col("cluster").alias("label"))
    return g.neighbourhood_enrichment(_edges(spark, sf), labels)


@query(
    "graph_enrichment",
    d.sql(
        "spots", extra=_EDGES + _ENRICH,
        body="SELECT type_a, type_b, n_edges, round(zscore, 6) AS zscore FROM scores",
    ),
)
def graph_enrichment(spark, sf):
    cleaned = g.clean_scores(_enrichment(spark, sf))
    return cleaned.withColumn("zscore", r6(F.col("zscore")))


@query(
    "graph_chord",
    d.sql(
        "spots", extra=_EDGES + _ENRICH,
        body="""SELECT source_name, target_name, value FROM (
    SELECT type_a::varchar AS source_name, type_b::varchar AS target_name, round(zscore, 6) AS value,
        row_number() OVER (PARTITION BY least(type_a, type_b), greatest(type_a, type_b)
                           ORDER BY type_a, round(zscore, 6) DESC, type_b) AS rn FROM scores)
WHERE rn = 1 AND source_name <> target_name AND value >= 0.0001""",
    ),
)
def graph_chord(spark, sf):
    matrix = g.clean_scores(_enrichment(spark, sf)).select(
        F.col("type_a").cast("string").alias("source_name"),
        F.col("type_b").cast("string").alias("target_name"),
        r6(F.col("zscore")).alias("value"),
    )
    return m.chord_edges(matrix)


@query("graph_enrichment_permuted")
def graph_enrichment_permuted(spark, sf):
    labels = _spots(spark, sf).select(F.col("barcode").alias("id"), F.col("cluster").alias("label"))
    return g.permuted_enrichment(_edges(spark, sf), labels, 1000)


_MORAN = """,
w AS (SELECT src, dst, 1.0::double / degree AS w FROM links JOIN deg USING (src)),
both_ways AS (
    SELECT src, dst, sum(w) AS t FROM (SELECT src, dst, w FROM w UNION ALL SELECT dst, src, w FROM w) GROUP BY 1, 2),
wm AS (
    SELECT sum(r) / 2 AS s0, sum(q) / 2 AS s1, sum(r * r) AS s2 FROM (
        SELECT src, sum(t * t) AS q, sum(t) AS r FROM both_ways GROUP BY 1)),
n AS (SELECT count(*)::double AS n FROM sp)"""


def _moran_body(values: str) -> str:
    return f""",
vals AS ({values}),
mean AS (SELECT marker, sum(value) / n AS m FROM vals, n GROUP BY marker, n),
dense AS (
    SELECT sp.barcode, mean.marker, coalesce(value, 0) - m AS z FROM sp CROSS JOIN mean
    LEFT JOIN vals ON vals.barcode = sp.barcode AND vals.marker = mean.marker),
ss AS (SELECT marker, sum(z * z) AS ss FROM dense GROUP BY 1),
num AS (
    SELECT a.marker, sum(w * a.z * b.z) AS num FROM w JOIN dense a ON a.barcode = src
    JOIN dense b ON b.barcode = dst AND b.marker = a.marker GROUP BY 1),
idx AS (SELECT marker, n * num / (s0 * ss) AS i, n, s0, s1, s2 FROM num JOIN ss USING (marker), n, wm)"""


_MORAN_OUT = """SELECT marker, round(i, 6) AS "I",
    round((i + 1 / (n - 1)) / sqrt((n * n * s1 - n * s2 + 3 * s0 * s0) / ((n - 1) * (n + 1) * s0 * s0)
          - 1 / ((n - 1) * (n - 1))), 6) AS zscore FROM idx"""


def _gene_values(spark, sf):
    tissue = _spots(spark, sf).select("barcode")
    return d.expr(spark, sf).join(tissue, "barcode", "left_semi").select(
        "barcode", F.col("gene").alias("marker"), F.col("count").alias("value")
    )


def _rounded(scored):
    return scored.select("marker", r6(F.col("I")).alias("I"), r6(F.col("zscore")).alias("zscore"))


@query(
    "moran_genes",
    d.sql(
        "expr", "spots",
        extra=_EDGES + _MORAN + _moran_body("SELECT barcode, gene AS marker, count AS value FROM expr JOIN sp USING (barcode)"),
        body=_MORAN_OUT,
    ),
)
def moran_genes(spark, sf):
    n = _spots(spark, sf).agg(F.count("*")).scalar()
    return _rounded(g.morans_i(_gene_values(spark, sf), _edges(spark, sf), n))


@query(
    "moran_cell_types",
    d.sql(
        "deconv", "spots",
        extra=_EDGES
        + _MORAN
        + _moran_body(
            """SELECT barcode, cell_type AS marker, n / sum(n) OVER (PARTITION BY barcode)::double AS value
    FROM deconv JOIN sp USING (barcode)"""
        ),
        body=_MORAN_OUT,
    ),
)
def moran_cell_types(spark, sf):
    tissue = _spots(spark, sf).select("barcode")
    shares = m.proportions(d.deconv(spark, sf)).join(tissue, "barcode", "left_semi")
    values = shares.select(
        "barcode", F.col("cell_type").alias("marker"), F.col("proportion").alias("value")
    )
    n = tissue.agg(F.count("*")).scalar()
    return _rounded(g.morans_i(values, _edges(spark, sf), n))


_MORAN_TESTED = (
    _EDGES
    + _MORAN
    + _moran_body("SELECT barcode, gene AS marker, count AS value FROM expr JOIN sp USING (barcode)")
    + f""",
zs AS MATERIALIZED (
    SELECT marker, i, (i + 1 / (n - 1)) / sqrt((n * n * s1 - n * s2 + 3 * s0 * s0) / ((n - 1) * (n + 1) * s0 * s0)
        - 1 / ((n - 1) * (n - 1))) AS z FROM idx),
tails AS MATERIALIZED (SELECT marker, i, z, {d.normal_tail_sql("abs(z)")} AS p FROM zs),
ranks AS (
    SELECT *, coalesce(p, 1) AS q, count(*) OVER () AS m,
           count(*) OVER (ORDER BY coalesce(p, 1) RANGE UNBOUNDED PRECEDING) AS rk FROM tails),
tested AS MATERIALIZED (
    SELECT marker, i, z, p, least(min(q * m / rk) OVER (ORDER BY q DESC RANGE UNBOUNDED PRECEDING), 1) AS adjusted
    FROM ranks)"""
)


def _moran_tested(spark, sf):
    """Normal p-values with step-up correction."""
    from ..functions.probability import normal_tail
    from ..operators.comparative import adjust_step_up

    n = _spots(spark, sf).agg(F.count("*")).scalar()
    scored = g.morans_i(_gene_values(spark, sf), _edges(spark, sf), n)
    tested = cut_lineage(scored.withColumn("pval_norm", normal_tail(F.abs("zscore"))))
    return adjust_step_up(tested, [], "pval_norm", "pval_norm_fdr_bh")


@query(
    "moran_genes_pvalues",
    d.sql(
        "expr", "spots", extra=_MORAN_TESTED,
        body="""SELECT marker, round(i, 6) AS "I", round(z, 6) AS zscore, round(p, 6) AS pval_norm,
    round(adjusted, 6) AS pval_norm_fdr_bh FROM tested""",
    ),
)
def moran_genes_pvalues(spark, sf):
    tested = _moran_tested(spark, sf)
    return tested.select("marker", *[r6(F.col(c)).alias(c) for c in ("I", "zscore", "pval_norm", "pval_norm_fdr_bh")])


@query(
    "moran_genes_significant",
    d.sql(
        "expr", "spots", extra=_MORAN_TESTED,
        body="""SELECT marker, round(i, 6) AS "I", round(adjusted, 6) AS pval_norm_fdr_bh
FROM tested WHERE adjusted < 0.05 ORDER BY i DESC, marker LIMIT 16""",
    ),
)
def moran_genes_significant(spark, sf):
    """The most autocorrelated genes among the significant ones."""
    top = g.significant_markers(_moran_tested(spark, sf), 16, "pval_norm_fdr_bh", 0.05)
    return top.select("marker", *[r6(F.col(c)).alias(c) for c in ("I", "pval_norm_fdr_bh")])


@query("moran_genes_permuted")
def moran_genes_permuted(spark, sf):
    return g.permuted_morans_i(_gene_values(spark, sf), _edges(spark, sf), _spots(spark, sf), 100)


@query(
    "graph_lagged_score",
    d.sql(
        "spots", extra=_EDGES,
        body="""SELECT src, count(*) AS degree, round(avg(score), 6) AS lag
FROM links JOIN sp ON dst = barcode GROUP BY 1""",
    ),
)
def graph_lagged_score(spark, sf):
    values = _spots(spark, sf).select(F.col("barcode").alias("id"), F.col("score").alias("value"))
    return g.lagged_values(values, _edges(spark, sf)).withColumn("lag", r6(F.col("lag")))


_LIMITS = co.radii(60)
_BANDS = f"""limits AS (
    SELECT unnest([{', '.join(map(str, _LIMITS[:-1]))}]) AS lo, unnest([{', '.join(map(str, _LIMITS[1:]))}]) AS hi,
           unnest(range(0, {len(_LIMITS) - 1})) AS band),
steps AS (SELECT lo + 1 AS step, hi FROM limits),
dist AS (
    SELECT a.cell_type AS type_a, b.cell_type AS type_b,
           ceil(sqrt((a.cell_x - b.cell_x) ** 2 + (a.cell_y - b.cell_y) ** 2))::int AS up, count(*) AS n
    FROM cells a CROSS JOIN cells b GROUP BY 1, 2, 3),
pairs AS (
    SELECT band::int AS band, hi, type_a, type_b, sum(n)::bigint AS n
    FROM dist JOIN limits ON up > lo AND up <= hi GROUP BY 1, 2, 3, 4)"""


@query(
    "cooccurrence_pairs",
    d.sql("cells", extra=_BANDS, body="SELECT band, type_a, type_b, n FROM pairs"),
)
def cooccurrence_pairs(spark, sf):
    return co.pair_counts(d.cells(spark, sf), None, _LIMITS)


@query(
    "cooccurrence_ratio",
    d.sql(
        "cells", extra=_BANDS,
        body="""SELECT hi AS distance, type_a, type_b, n,
    round((n / sum(n) OVER (PARTITION BY hi, type_a)::double)
        / (sum(n) OVER (PARTITION BY hi, type_b) / sum(n) OVER (PARTITION BY hi)::double), 6) AS ratio
FROM pairs""",
    ),
)
def cooccurrence_ratio(spark, sf):
    counts = co.pair_counts(d.cells(spark, sf), None, _LIMITS)
    return co.co_occurrence(counts, _LIMITS).withColumn("ratio", r6(F.col("ratio")))


@query(
    "slides_cooccurrence_pairs",
    d.sql(
        "cells", extra=_BANDS.replace("GROUP BY 1, 2, 3),", "GROUP BY 1, 2, 3, 4),").replace(
            "a.cell_type AS type_a,", "a.cell_ids % 3 AS slide, a.cell_type AS type_a,"
        ).replace("CROSS JOIN cells b", "JOIN cells b ON a.cell_ids % 3 = b.cell_ids % 3").replace(
            "AS band, hi, type_a", "AS band, hi, slide, type_a"
        ).replace("GROUP BY 1, 2, 3, 4)", "GROUP BY ALL)"),
        body="SELECT slide, band, type_a, type_b, n FROM pairs",
    ),
)
def slides_cooccurrence_pairs(spark, sf):
    """Three slides over the same ground: only cells of one slide meet."""
    cells = d.cells(spark, sf).withColumn("slide", F.col("cell_ids") % 3)
    return co.pair_counts(cells, None, _LIMITS, by=["slide"])


@query("graph_delaunay_degrees")
def graph_delaunay_degrees(spark, sf):
    """Number of Delaunay neighbours of every cell."""
    from ..operators.delaunay import delaunay_edges

    points = d.cells(spark, sf).select(
        F.col("cell_ids").alias("id"), F.col("cell_x").alias("x"), F.col("cell_y").alias("y")
    )
    return g.degrees(delaunay_edges(points))


@query("graph_cell_enrichment")
def graph_cell_enrichment(spark, sf):
    """Enrichment of cell-type pairs over the Delaunay graph."""
    from ..operators.delaunay import delaunay_edges

    cells = d.cells(spark, sf)
    points = cells.select(
        F.col("cell_ids").alias("id"), F.col("cell_x").alias("x"), F.col("cell_y").alias("y")
    )
    labels = cells.select(F.col("cell_ids").alias("id"), F.col("cell_type").alias("label"))
    return g.clean_scores(g.neighbourhood_enrichment(cut_lineage(delaunay_edges(points)), labels))
