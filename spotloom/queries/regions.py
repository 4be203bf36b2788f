"""Differential expression between clusters and between annotated regions."""

from pyspark.sql import functions as F

from .. import domain as d
from ..functions.numeric import r6
from ..operators import comparative as c
from ..operators import spatial as sp
from ..registry import query
from .space import _SPOTS_IN

_CLUSTER_MEMBERS = "members AS (SELECT barcode, cluster AS region FROM spots WHERE in_tissue = 1)"
_CLASS_MEMBERS = _SPOTS_IN + """,
kept AS (SELECT region_name FROM spots_in GROUP BY 1 HAVING count(*) > 1),
members AS (SELECT barcode, region_class AS region FROM spots_in WHERE region_name IN (SELECT region_name FROM kept))"""

_STATS = """,
sizes AS (SELECT region, count(*)::double AS n FROM members GROUP BY 1 HAVING count(*) >= 2),
hit_genes AS (SELECT DISTINCT gene FROM expr JOIN members USING (barcode)),
hist AS (
    SELECT gene, region, count AS value, count(*)::double AS n
    FROM expr JOIN members USING (barcode) GROUP BY 1, 2, 3),
full_hist AS (
    SELECT gene, region, value, n FROM hist JOIN sizes s USING (region, n) WHERE false
    UNION ALL SELECT gene, region, value, hist.n FROM hist JOIN sizes USING (region)
    UNION ALL
    SELECT g.gene, s.region, 0, s.n - coalesce(nz, 0) FROM hit_genes g CROSS JOIN sizes s
    LEFT JOIN (SELECT gene, region, sum(n) AS nz FROM hist GROUP BY 1, 2) z
      ON z.gene = g.gene AND z.region = s.region
    WHERE s.n - coalesce(nz, 0) > 0),
folds AS (
    SELECT gene, region, sum(value * n) AS s1, sum(value * value * n) AS s2, sum(n) AS n
    FROM full_hist GROUP BY 1, 2),
us AS (
    SELECT a.gene, a.region AS ra, b.region AS rb,
           sum(a.n * b.n * CASE WHEN b.value < a.value THEN 1.0 WHEN b.value = a.value THEN 0.5 ELSE 0 END)::double AS u
    FROM full_hist a JOIN full_hist b USING (gene) GROUP BY 1, 2, 3),
stats AS (
    SELECT a.gene, a.region AS region_a, b.region AS region_b, a.n AS n1, b.n AS n2,
           a.s1 / a.n AS mean1, b.s1 / b.n AS mean2,
           (a.s2 - a.s1 * a.s1 / a.n) + (b.s2 - b.s1 * b.s1 / b.n) AS within, a.s2 + b.s2 AS scale
    FROM folds a JOIN folds b USING (gene))"""

_STATS_OUT = """SELECT stats.gene, region_a, region_b, n1::bigint AS n1, n2::bigint AS n2,
    round(mean1, 6) AS mean1, round(mean2, 6) AS mean2,
    CASE WHEN mean2 = 0 THEN 'inf' WHEN mean1 > 0 THEN 'finite' ELSE 'inf' END AS fc_kind,
    CASE WHEN mean2 > 0 AND mean1 > 0 THEN round(mean1 / mean2, 6) END AS fc,
    CASE WHEN within > 1e-9 * scale
         THEN round((mean1 - mean2) / sqrt(within / (n1 + n2 - 2) * (1 / n1 + 1 / n2)), 6) END AS t,
    round(u, 3) AS u
FROM stats JOIN us ON us.gene = stats.gene AND ra = region_a AND rb = region_b"""


def _cluster_members(spark, sf):
    return (
        d.spots(spark, sf).filter("in_tissue = 1").select("barcode", F.col("cluster").alias("region"))
    )


def _class_members(spark, sf):
    hits = sp.members_of_sized_regions(d.spots(spark, sf), d.regions(spark, sf))
    return hits.select("barcode", F.col("region_class").alias("region"))


def _shown(stats):
    finite = F.abs("fc") != F.lit(float("inf"))
    return stats.select(
        "gene", "region_a", "region_b", "n1", "n2",
        r6(F.col("mean1")).alias("mean1"),
        r6(F.col("mean2")).alias("mean2"),
        F.when(finite, "finite").otherwise("inf").alias("fc_kind"),
        F.when(finite, r6(F.col("fc"))).alias("fc"),
        r6(F.col("t")).alias("t"),
        F.round("u", 3).alias("u"),
    )


@query(
    "compare_clusters",
    d.sql("expr", "spots", extra=_CLUSTER_MEMBERS + _STATS, body=_STATS_OUT),
)
def compare_clusters(spark, sf):
    return _shown(c.pairwise_statistics(d.expr(spark, sf), _cluster_members(spark, sf)))


@query(
    "compare_regions",
    d.sql("expr", "spots", "regions", extra=_CLASS_MEMBERS + _STATS, body=_STATS_OUT),
)
def compare_regions(spark, sf):
    return _shown(c.pairwise_statistics(d.expr(spark, sf), _class_members(spark, sf)))


@query("compare_clusters_tested")
def compare_clusters_tested(spark, sf):
    """p-values, corrections, significance and direction of every comparison."""
    return c.compare_regions(d.expr(spark, sf), _cluster_members(spark, sf))


def _adjusted_sql(p: str, out: str, of: str) -> str:
    """Step-up adjusted p-values within each pair of regions; a missing one counts as 1."""
    return f"""
{out}_ranks AS (
    SELECT *, coalesce({p}, 1) AS q, count(*) OVER (PARTITION BY region_a, region_b) AS m,
           count(*) OVER (PARTITION BY region_a, region_b ORDER BY coalesce({p}, 1) RANGE UNBOUNDED PRECEDING) AS rk
    FROM {of}),
{out}_table AS MATERIALIZED (
    SELECT * EXCLUDE (q, m, rk), least(min(q * m / rk)
        OVER (PARTITION BY region_a, region_b ORDER BY q DESC RANGE UNBOUNDED PRECEDING), 1) AS {out} FROM {out}_ranks)"""


_SIGNIFICANCE = f""",
ties AS (
    SELECT gene, ra, rb, sum(t * t * t - t) AS ties FROM (
        SELECT gene, ra, rb, value, sum(n) AS t FROM (
            SELECT gene, a.region AS ra, b.region AS rb, value, h.n FROM full_hist h, sizes a, sizes b WHERE h.region = a.region
            UNION ALL
            SELECT gene, a.region, b.region, value, h.n FROM full_hist h, sizes a, sizes b WHERE h.region = b.region)
        GROUP BY 1, 2, 3, 4) GROUP BY 1, 2, 3),
scores AS MATERIALIZED (
    SELECT s.gene, region_a, region_b, n1 + n2 - 2 AS df, mean1, mean2,
           CASE WHEN within > 1e-9 * scale
                THEN (mean1 - mean2) / sqrt(within / (n1 + n2 - 2) * (1 / n1 + 1 / n2)) END AS t,
           abs((greatest(u, n1 * n2 - u) - n1 * n2 / 2 - 0.5) / nullif(sqrt(greatest(
               n1 * n2 / 12 * ((n1 + n2 + 1) - ties / ((n1 + n2) * (n1 + n2 - 1))), 0)), 0)) AS z
    FROM stats s JOIN us ON us.gene = s.gene AND us.ra = region_a AND us.rb = region_b
    JOIN ties ON ties.gene = s.gene AND ties.ra = region_a AND ties.rb = region_b),
ps AS MATERIALIZED (
    SELECT *, {d.student_two_sided_sql("t", "df")} AS tp, coalesce(least(2 * ({d.normal_tail_sql("z")}), 1), 1) AS mp
    FROM scores),
{_adjusted_sql("tp", "ct", "ps")},
{_adjusted_sql("mp", "cm", "ct_table")}"""


@query(
    "compare_clusters_significance",
    d.sql(
        "expr", "spots", extra=_CLUSTER_MEMBERS + _STATS + _SIGNIFICANCE,
        body="""SELECT gene, region_a, region_b, round(tp, 6) AS t_pvalue, round(mp, 6) AS mw_pvalue,
    round(ct, 6) AS corrected_t_pvalue, round(cm, 6) AS corrected_mw_pvalue, ct < 0.05 AND cm < 0.05 AS is_significant,
    CASE WHEN ct >= 0.05 OR cm >= 0.05 THEN 'not significant'
         WHEN mean2 = 0 OR mean1 = 0 OR mean1 / mean2 >= 3 THEN 'upregulated'
         WHEN mean1 / mean2 <= 1 / 3.0::double THEN 'downregulated' ELSE 'not significant' END AS direction
FROM cm_table""",
    ),
)
def compare_clusters_significance(spark, sf):
    """p-values of both tests, their corrections, and which genes differ in which direction."""
    tested = c.compare_regions(d.expr(spark, sf), _cluster_members(spark, sf))
    numbers = ["t_pvalue", "mw_pvalue", "corrected_t_pvalue", "corrected_mw_pvalue"]
    return tested.select(
        "gene", "region_a", "region_b", *[r6(F.col(n)).alias(n) for n in numbers], "is_significant", "direction"
    )


@query(
    "compare_step_up",
    d.sql(
        body="""WITH p AS (SELECT l_suppkey AS family, l_orderkey, l_linenumber, l_partkey,
    round((l_extendedprice % 997) / 997, 4) AS p FROM lineitem),
r AS (SELECT *, count(*) OVER (PARTITION BY family) AS n,
             count(*) OVER (PARTITION BY family ORDER BY p RANGE UNBOUNDED PRECEDING) AS rk FROM p)
SELECT family, l_orderkey, l_linenumber, l_partkey, p,
    round(least(min(p * n / rk) OVER (PARTITION BY family ORDER BY p DESC RANGE UNBOUNDED PRECEDING), 1), 6) AS adjusted
FROM r"""
    ),
)
def compare_step_up(spark, sf):
    """Step-up correction of many families of scores at once."""
    scores = d.table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("family"), "l_orderkey", "l_linenumber", "l_partkey",
        F.round((F.col("l_extendedprice") % 997) / 997, 4).alias("p"),
    )
    return c.adjust_step_up(scores, ["family"], "p", "adjusted").withColumn(
        "adjusted", r6(F.col("adjusted"))
    )
