"""Gene selection: totals, variability, name matching and reference filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import ratio, sample_variance


def drop_unusable_genes(expr: DataFrame, features: DataFrame) -> DataFrame:
    """Drop deprecated probes and genes without any count; add up duplicate names.

    ``features`` maps ``gene`` to ``gene_name``; the result is keyed by name.
    """
    kept = features.filter(~F.col("gene_name").contains("DEPRECATED"))
    named = expr.join(kept.select("gene", "gene_name"), "gene")
    return (
        named.groupBy("barcode", "gene_name")
        .agg(F.sum("count").alias("count"))
        .filter("count > 0")
    )


def gene_moments(expr: DataFrame, n_spots: Column) -> DataFrame:
    """Total, mean and sample variance over all spots; absent entries count as zero."""
    grouped = expr.groupBy("gene").agg(
        F.sum("count").alias("total"),
        F.sum(F.col("count") * F.col("count")).cast("double").alias("_squares"),
    )
    return grouped.select(
        "gene",
        "total",
        ratio(F.col("total"), n_spots).alias("mean"),
        sample_variance(n_spots, F.col("total").cast("double"), F.col("_squares")).alias("variance"),
    )


def top_genes(moments: DataFrame, n: int, mode: str = "expression") -> DataFrame:
    """The n genes with the largest total (or variance); ties go to the smaller name."""
    score = "variance" if mode.lower() == "variability" else "total"
    return moments.orderBy(F.desc(score), F.asc("gene")).limit(n)


def target_genes(
    moments: DataFrame,
    wanted: DataFrame | None,
    n_expressed: int = 0,
    n_variable: int = 0,
) -> DataFrame:
    """Distinct union of named targets, most expressed and most variable genes."""
    parts = [] if wanted is None else [wanted.select("gene")]
    if n_expressed:
        parts.append(top_genes(moments, n_expressed).select("gene"))
    if n_variable:
        parts.append(top_genes(moments, n_variable, "variability").select("gene"))
    result = parts[0]
    for part in parts[1:]:
        result = result.union(part)
    return result.distinct()


def match_gene_names(genes: DataFrame, targets: Sequence[str], fallback: int = 5) -> DataFrame:
    """Genes whose upper-case name contains a target; a few fixed ones if none does."""
    hits = genes.withColumn("gene_name", F.upper("gene_name"))
    wanted = F.array(*[F.lit(t.upper()) for t in targets]).cast("array<string>")
    matched = hits.filter(F.exists(wanted, lambda t: F.contains(F.col("gene_name"), t)))
    spare = hits.orderBy("gene_name").limit(fallback)
    return matched.unionByName(
        spare.filter(matched.agg(F.count("*")).scalar() == 0)
    ).dropDuplicates(["gene_name"])


def filter_reference_genes(
    expr: DataFrame,
    n_cells: Column,
    min_cells: int = 5,
    min_share: float = 0.03,
    min_nonzero_mean: float = 1.12,
) -> DataFrame:
    """Genes seen in enough cells, or in fewer cells but strongly.

    Published rule of the reference-signature gene filter: keep a gene if it is
    expressed in more than ``min_share`` of the cells, or in more than ``min_cells``
    cells with a nonzero mean above ``min_nonzero_mean``.
    """
    grouped = expr.groupBy("gene").agg(
        F.count_if(F.col("count") > 0).alias("n_cells"),
        F.avg(F.when(F.col("count") > 0, F.col("count").cast("double"))).alias("nonzero_mean"),
    )
    common = F.col("n_cells") > n_cells.cast("double") * min_share
    strong = (F.col("n_cells") > min_cells) & (F.col("nonzero_mean") > min_nonzero_mean)
    return grouped.filter(common | strong)


def analysis_genes(columns: Sequence[str], cell_types: Sequence[str] = ()) -> list[str]:
    """Column names that count as genes in a wide table: upper case, no '-' and no '.'."""
    skip = set(cell_types)
    return [
        c
        for c in dict.fromkeys(columns)
        if c.isupper() and "-" not in c and "." not in c and c not in skip
    ]


def gene_name_is_analysable(name: Column) -> Column:
    return (
        (F.upper(name) == name)
        & (F.lower(name) != name)
        & ~F.contains(name, F.lit("-"))
        & ~F.contains(name, F.lit("."))
    )
