"""The analysis stages as functions from tables to lazy tables.

Input tables come in a dict: ``expr``, ``spots``, ``genes``, ``cells``, ``deconv``,
``features`` (morphology) and ``regions``; every stage reads what it needs and
returns named DataFrames. Nothing runs until a table is written or collected.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import (
    annealing,
    assignment,
    comparative,
    cooccurrence,
    deconvolution,
    delaunay,
    genes,
    graph,
    merge,
    morphology,
    qc,
    spatial,
    summaries,
    variability,
)
from ..session import cut_lineage
from ..sources.readers import allowed

Tables = dict[str, DataFrame]


@dataclass
class Settings:
    """Parameters of a run; stages and figures that are off cost nothing."""

    enabled: tuple[str, ...] = ("cell2spot", "celldeconv", "cluster", "assign", "qc", "datamerge", "spatialanalysis")
    spot_diameter: float = 65.0
    mitochondrial_prefixes: tuple[str, ...] = ("MT-",)
    mitochondrial_genes: tuple[str, ...] = ()
    abundance_threshold: float = 0.1
    cluster_method: str = "gaussian"
    cluster_count: int = 5
    assign_method: str = "local"
    target_genes: tuple[str, ...] = ()
    n_top_expressed: int = 1000
    n_top_variable: int = 0
    rings: int = 2
    intervals: int = 60
    moran_p: float = 0.05
    diff_p: float = 0.05
    diff_fold: float = 3.0
    infiltration_levels: int = 4
    min_cells_for_graph: int = 4
    cell_types: tuple[str, ...] = ()  # those of the cells when empty
    slide: tuple[str, ...] = ()  # columns that tell the slides of a run apart
    min_region_spots: int = 2
    figures: tuple[str, ...] = field(
        default=(
            "cell_summary", "cell_counts", "cell_per_spot", "spot_avg_gene_counts",
            "cell_net_matrix", "cell_net_chord", "cell_cooccur", "morans_gene", "morans_cell",
            "variable_genes", "diff_exp_clusters", "diff_exp_annotations",
        )
    )


def _slide(s: Settings) -> Column:
    """One value per slide, for operators that take a single sample column."""
    return F.concat_ws("/", *[F.col(c).cast("string") for c in s.slide]) if s.slide else F.lit("sample")


def cell2spot(t: Tables, s: Settings) -> Tables:
    radius = s.spot_diameter // 2
    cells = spatial.assign_cells_to_spots(t["cells"], t["spots"], radius, by=s.slide)
    return {"cells": cells, "spots": spatial.contained_cells(cells, t["spots"], s.slide)}


def celldeconv(t: Tables, s: Settings) -> Tables:
    """Integer counts per type from abundances and contained cells."""
    sizes = t["spots"].select("barcode", F.col("num_contained_cells").alias("cell_n"))
    return {"deconv": deconvolution.counts_from_abundance(t["abundance"], sizes, s.abundance_threshold)}


def cluster(t: Tables, s: Settings) -> Tables:
    scaled = morphology.standardise(t["features"])
    return {"morphological_clusters": morphology.cluster(scaled, s.cluster_method, s.cluster_count)}


def _assign_local(cells: DataFrame, deconv: DataFrame) -> DataFrame:
    return annealing.local_assignment(cells.select("cell_ids", "barcode", "features"), deconv)


def _assign_naive(cells: DataFrame, deconv: DataFrame) -> DataFrame:
    return assignment.naive_assignment(cells.select("cell_ids", "barcode"), deconv)


def _assign_global(cells: DataFrame, deconv: DataFrame) -> DataFrame:
    clusters = morphology.cluster(cells, "kmeans", 20).withColumnRenamed("clusters", "cluster_name")
    dealt = cut_lineage(
        assignment.naive_assignment(clusters.select("cell_ids", "barcode", "cluster_name"), deconv)
    )
    p_spot = summaries.spot_probability(dealt)
    p_cluster = summaries.cluster_probability(dealt, p_spot)
    combined = summaries.combined_probability(dealt, p_spot, p_cluster)
    best = assignment.optimal_allocation(
        dealt.select("cell_ids", "barcode", "cluster_name", "cell_type"), combined
    )
    return best.join(dealt.select("cell_ids", "spot_clusters"), "cell_ids").drop("cluster_name")


ASSIGNERS: dict[str, Callable[[DataFrame, DataFrame], DataFrame]] = {
    "local": _assign_local,
    "naive": _assign_naive,
    "global": _assign_global,
}


def assign(t: Tables, s: Settings) -> Tables:
    """Types of the cells inside spots, with confidence scores."""
    method = ASSIGNERS[allowed("assign_method", s.assign_method, list(ASSIGNERS))]
    reduced = morphology.reduce(morphology.standardise(t["features"]), 10)
    inside = reduced.join(t["cells"].select("cell_ids", "barcode"), "cell_ids").filter("barcode is not null")
    typed = cut_lineage(method(cut_lineage(inside), t["deconv"]))
    scored = assignment.confidence(
        typed.filter("spot_clusters is not null").join(inside.select("cell_ids", "features"), "cell_ids")
    )
    return {"spot_clusters": scored.drop("features")}


def quality(t: Tables, s: Settings) -> Tables:
    args = (t["expr"], t["spots"], t["genes"], s.mitochondrial_prefixes, s.mitochondrial_genes)
    if s.slide:
        samples = t["spots"].select("barcode", _slide(s).alias("exp_id"))
        overall = qc.overall_qc_by_sample(t["expr"], samples)
    else:
        overall = qc.overall_qc(t["expr"], "sample")
    return {
        "spot_qc": qc.spot_qc(*args),
        "gene_qc": qc.gene_qc(*args),
        "overall_qc": overall,
    }


def datamerge(t: Tables, s: Settings) -> Tables:
    spine = t["spots"].filter("in_tissue = 1")
    n = spine.agg(F.count("*")).scalar()
    moments = genes.gene_moments(t["expr"], n)
    wanted = t["genes"].select("gene")
    if s.target_genes:
        names = genes.match_gene_names(t["genes"], s.target_genes)
        wanted = names.select("gene")
    elif not (s.n_top_expressed or s.n_top_variable):
        wanted = t["genes"].select("gene")
    else:
        wanted = None
    selected = genes.target_genes(moments, wanted, s.n_top_expressed, s.n_top_variable)
    shares = merge.proportions(t["deconv"])
    quality_columns = t["spot_qc"].select("barcode", *[c for c in t["spot_qc"].columns if "qc_" in c])
    spots = merge.merge_on("barcode", spine, quality_columns, t.get("tsne"), t.get("umap"))
    typed = t["spot_clusters"].select("cell_ids", "cell_type")
    clusters = t["morphological_clusters"].select(
        "cell_ids", F.col("clusters").cast("string").alias("morphological_cluster")
    )
    cells = merge.merge_on("cell_ids", t["cells"].drop("cell_type"), clusters, typed).withColumn(
        "cell_type", merge.normalise_label(merge.fill_cell_type(F.col("cell_type")))
    ).withColumn(
        # The label of untyped cells keeps its space.
        "cell_type",
        F.when(F.col("cell_type") == "not-deconvolved", merge.NOT_DECONVOLVED).otherwise(F.col("cell_type")),
    )
    return {
        "merged_spots": spots,
        "merged_cells": cells,
        "merged_expr": t["expr"].join(selected, "gene", "left_semi"),
        "merged_proportions": shares,
    }


def tissue_figures(t: Tables, s: Settings) -> Tables:
    """The data behind every tissue-level figure that is switched on."""
    cells = merge.keep_deconvolved(t["merged_cells"])
    spots, expr = t["merged_spots"], t["merged_expr"]
    n = spots.agg(F.count("*")).scalar()
    edges = graph.lattice_edges(spots, s.rings, s.slide)
    values = {
        "gene": expr.select("barcode", F.col("gene").alias("marker"), F.col("count").alias("value")),
        "cell": t["merged_proportions"].select(
            "barcode", F.col("cell_type").alias("marker"), F.col("proportion").alias("value")
        ),
    }
    tissue = spots.select("barcode")

    def neighbours() -> DataFrame:
        points = cells.select(
            F.col("cell_ids").alias("id"), F.col("cell_x").alias("x"), F.col("cell_y").alias("y")
        )
        labels = cells.select(F.col("cell_ids").alias("id"), F.col("cell_type").alias("label"))
        links = cut_lineage(delaunay.delaunay_edges(points))
        return graph.clean_scores(graph.neighbourhood_enrichment(links, labels))

    def chord() -> DataFrame:
        return merge.chord_edges(
            neighbours().select(
                F.col("type_a").alias("source_name"),
                F.col("type_b").alias("target_name"),
                F.col("zscore").alias("value"),
            )
        )

    def together() -> DataFrame:
        limits = cooccurrence.radii(s.intervals)
        counts = cooccurrence.pair_counts(cells, s.cell_types or None, limits, by=s.slide)
        return cooccurrence.co_occurrence(counts, limits, s.slide)

    def moran(kind: str) -> DataFrame:
        inside = values[kind].join(tissue, "barcode", "left_semi")
        return graph.morans_i(inside, edges, n).orderBy(F.desc("I"), "marker")

    def members(column: str) -> DataFrame:
        return spots.select("barcode", F.col(column).cast("string").alias("region"))

    def annotated() -> DataFrame:
        hits = spatial.members_of_sized_regions(spots, t["regions"], s.min_region_spots, s.slide)
        regions = hits.select("barcode", F.col("region_class").alias("region"))
        return comparative.compare_regions(expr, regions, s.diff_p, s.diff_fold)

    makers: dict[str, Callable[[], DataFrame]] = {
        "cell_summary": lambda: summaries.spot_statistics(cells),
        "cell_counts": lambda: summaries.cells_per_type(cells),
        "cell_per_spot": lambda: summaries.type_counts(cells),
        "spot_avg_gene_counts": lambda: genes.top_genes(genes.gene_moments(expr, n), 10),
        "cell_net_matrix": neighbours,
        "cell_net_chord": chord,
        "cell_cooccur": together,
        "morans_gene": lambda: moran("gene"),
        "morans_cell": lambda: moran("cell"),
        "variable_genes": lambda: variability.spatial_variability(
            expr,
            spots.select(
                _slide(s).alias("exp_id"), "barcode",
                F.col("pxl_col_in_fullres").cast("double").alias("x"),
                F.col("pxl_row_in_fullres").cast("double").alias("y"),
            ),
        ),
        "diff_exp_clusters": lambda: comparative.compare_regions(
            expr, members("cluster"), s.diff_p, s.diff_fold
        ),
        "diff_exp_annotations": annotated,
    }
    return {name: makers[name]() for name in s.figures if name in makers}


def region_figures(t: Tables, s: Settings) -> Tables:
    """Infiltration of every annotated region at once."""
    step = int(s.spot_diameter)
    cells = merge.keep_deconvolved(t["merged_cells"])
    levels = spatial.infiltration_levels(cells, t["regions"], step, s.infiltration_levels, by=s.slide)
    table = spatial.infiltration_table(levels, s.spot_diameter, step, s.slide)
    return {
        "infilt_comparing_cell_types": spatial.infiltration_grid(levels, s.slide),
        "infilt_comparing_levels": table,
        "infilt_test": spatial.infiltration_test(table, by=s.slide),
    }


STAGES: dict[str, Callable[[Tables, Settings], Tables]] = {
    "cell2spot": cell2spot,
    "celldeconv": celldeconv,
    "cluster": cluster,
    "assign": assign,
    "qc": quality,
    "datamerge": datamerge,
    "spatialanalysis": lambda t, s: {**tissue_figures(t, s), **(region_figures(t, s) if "regions" in t else {})},
}


def run(tables: Tables, settings: Settings, out: str | None = None) -> Tables:
    """Run the enabled stages in order; later stages read what earlier ones stored.

    With ``out`` every result is written as a table and read back, so a lost
    executor costs one stage at most.
    """
    state = dict(tables)
    for name, stage in STAGES.items():
        if name not in settings.enabled:
            continue
        for key, df in stage(state, settings).items():
            if out is not None:
                path = f"{out}/{name}/{key}"
                df.write.mode("overwrite").parquet(path)
                df = df.sparkSession.read.parquet(path)
            state[key] = df
    return state
