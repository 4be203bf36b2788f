"""Differential expression between regions on sparse counts.

Every statistic is built from one fold per (gene, region) and one histogram per
(gene, region, value). Zeros are never stored: the spots of a region without an
entry form one block whose size is known.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import value_bucket
from ..functions.ordering import running_min_from_top, running_sum
from ..functions.probability import normal_two_sided, student_two_sided
from ..session import cut_lineage

HEAVY = 4  # a gene with over 1 / (HEAVY x cores) of all entries is cut into value ranges
LIGHT_ROWS = 10_000  # but not one with fewer entries than these
DENSE = 1 << 20  # numbers of a table of values x regions, or of genes x pairs of regions
JOINT = 16  # regions up to which the tables of many genes are filled together
SUMS = ("nz", "x", "xx", "cubes", "above", "level", "twice")
PAIRED = (*(f"{c}{i}" for i in (1, 2) for c in SUMS[:4]), "above", "level", "twice12", "twice21")


def p_bucket(p: Column) -> Column:
    """A monotone code of a p-value; under the null no code holds over 1/4096 of a family."""
    fine = F.floor(p * 4096) + 100000
    small = F.floor(F.ln(F.greatest(p, F.lit(1e-300))) * 50)
    return F.when(p >= 0.01, fine).otherwise(small + 50000).cast("long")


def adjust_step_up(df: DataFrame, family: Sequence[str], p: str, out: str) -> DataFrame:
    """Benjamini-Hochberg step-up adjusted p-values within each family.

    A missing p-value counts as 1. Equal p-values share the largest rank, which is
    what the step-up minimum gives them. Families are folded to distinct values
    and scanned in value ranges, so a family may be of any size.
    """
    family = list(family)
    if not family:
        return adjust_step_up(df.withColumn("_one", F.lit(1)), ["_one"], p, out).drop("_one")
    filled = df.withColumn("_p", F.coalesce(F.nanvl(F.col(p), F.lit(1.0)), F.lit(1.0)))
    distinct = cut_lineage(filled.groupBy(*family, "_p").agg(F.count("*").alias("_c")))
    ranked = running_sum(
        distinct, family, p_bucket(F.col("_p")), [F.col("_p")], F.col("_c"), "_rank", total="_n"
    )
    scored = ranked.withColumn("_raw", F.col("_p") * F.col("_n") / F.col("_rank"))
    adjusted = running_min_from_top(
        scored, family, p_bucket(F.col("_p")), F.col("_p"), F.col("_raw"), out
    )
    lookup = adjusted.select(*family, "_p", F.least(F.col(out), F.lit(1.0)).alias(out))
    return filled.join(lookup, [*family, "_p"]).drop("_p")


def region_sizes(members: DataFrame, min_spots: int = 2) -> DataFrame:
    """(region, n) of regions with enough spots. A spot may count more than once."""
    return (
        members.groupBy("region")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") >= min_spots)
    )


def _weighted_expr(expr: DataFrame, members: DataFrame) -> DataFrame:
    """(region, gene, value, weight): counts of the spots of every region."""
    # A spot inside several polygons of one class is listed once per polygon.
    weights = members.groupBy("barcode", "region").agg(F.count("*").alias("weight"))
    return expr.join(weights, "barcode").select(
        "region", "gene", F.col("count").alias("value"), "weight"
    )


def region_histogram(expr: DataFrame, members: DataFrame) -> DataFrame:
    """(gene, region, value, n) over the nonzero entries, folded before it is shuffled on."""
    return (
        _weighted_expr(expr, members)
        .groupBy("gene", "region", "value")
        .agg(F.sum("weight").alias("n"))
    )


def pairwise_statistics(
    expr: DataFrame, members: DataFrame, compat: bool = True
) -> DataFrame:
    """Means, fold change, t and U of every gene for every ordered pair of regions.

    ``members`` lists (barcode, region). Self pairs are kept. The list of regions
    is the label set of the annotation; it travels as one small array, and each
    gene's row is unfolded over it twice, so region pairs need no join.

    With ``compat`` the fold change is infinite whenever the second mean is zero
    or the first one is while the second is not; otherwise it is the plain ratio.
    """
    sums = pair_sums(region_histogram(expr, members), region_sizes(members))
    mean1, mean2 = F.col("x1") / F.col("n1"), F.col("x2") / F.col("n2")
    n1, n2 = F.col("n1"), F.col("n2")
    within = (
        F.greatest(F.col("xx1") - F.col("x1") * mean1, F.lit(0.0))
        + F.greatest(F.col("xx2") - F.col("x2") * mean2, F.lit(0.0))
    )
    pooled = within / (n1 + n2 - 2)
    spread = F.sqrt(pooled * (1 / n1 + 1 / n2))
    infinite = F.lit(float("inf"))
    if compat:
        fold = (
            F.when(mean2 == 0, infinite)
            .when(mean1 > 0, mean1 / F.when(mean2 != 0, mean2))
            .otherwise(infinite)
        )
    else:
        fold = F.try_divide(mean1, mean2)
    return sums.select(
        "gene",
        "region_a",
        "region_b",
        n1.cast("long").alias("n1"),
        n2.cast("long").alias("n2"),
        mean1.alias("mean1"),
        mean2.alias("mean2"),
        fold.alias("fc"),
        F.try_divide(mean1 - mean2, F.when(within > 1e-9 * (F.col("xx1") + F.col("xx2")), spread)).alias("t"),
        "u",
        "ties",
    )


def pair_sums(histogram: DataFrame, sizes: DataFrame) -> DataFrame:
    """Sums, squares, Mann-Whitney U and tie term of every gene and region pair.

    U of the first region = sum over values v of n_a(v) * (#b below v + #b at v / 2),
    ties = sum of t^3 - t. Both split into sums of one region (its entries, their squares
    and cubes, its zeros) and cross terms of two regions that hold entries of the gene.
    Regions without entries have no cross terms, so nothing is unfolded over values and
    regions: one pass over the entries of a gene gives all its cross terms.
    """
    regions = sizes.agg(F.sort_array(F.collect_list(F.struct("region", F.col("n").cast("double").alias("n"))))).scalar()
    names = sizes.agg(F.sort_array(F.collect_list("region"))).scalar()
    coded = histogram.withColumn("code", F.array_position(names, F.col("region")).cast("int")).filter("code > 0")
    entries = cut_lineage(coded.select("gene", "code", F.col("value").cast("double").alias("value"), F.col("n").cast("double").alias("n")))
    heavy = _heavy_genes(entries)
    if heavy:
        cut = F.coalesce(F.col("gene").isin(heavy), F.lit(False))
        found = _light_pairs(entries.filter(~cut), names).unionByName(_heavy_pairs(entries.filter(cut), names))
    else:
        found = _light_pairs(entries, names)
    paired = found.withColumn("_r", regions).withColumns({"_a": F.get("_r", F.col("a")), "_b": F.get("_r", F.col("b"))})
    za, zb = F.col("_a.n") - F.col("nz1"), F.col("_b.n") - F.col("nz2")
    block = za + zb
    tied = F.col("cubes1") + F.col("cubes2") + 3 * (F.col("twice12") + F.col("twice21"))
    return paired.select(
        "gene",
        F.col("_a.region").alias("region_a"),
        F.col("_b.region").alias("region_b"),
        F.col("_a.n").alias("n1"),
        F.col("_b.n").alias("n2"),
        "x1",
        "xx1",
        "x2",
        "xx2",
        (F.col("nz1") * zb + F.col("above") + F.col("level") / 2 + za * zb / 2).alias("u"),
        (tied - F.col("nz1") - F.col("nz2") + block * block * block - block).alias("ties"),
    )


def _heavy_genes(entries: DataFrame) -> list:
    """Genes with more than one entry in HEAVY times the cores; there are fewer than these."""
    parts = HEAVY * entries.sparkSession.sparkContext.defaultParallelism
    counts = entries.groupBy("gene").agg(F.count("*").alias("rows"))
    total = counts.agg(F.sum("rows")).scalar()
    heavy = counts.filter((F.col("rows") * parts > total) & (F.col("rows") > LIGHT_ROWS)).select("gene")
    return [r["gene"] for r in heavy.collect()]


def _light_pairs(entries: DataFrame, names: Column) -> DataFrame:
    """(gene, a, b, PAIRED) of genes whose entries stand in one task, for each two of all regions by number from 0."""
    gene = entries.schema["gene"].dataType.simpleString()
    numbers = ", ".join(f"{c} double" for c in PAIRED)
    whole = entries.select("gene", F.lit(0).cast("long").alias("range"), "code", "value", "n", F.size(names).alias("k"))
    dealt = whole.repartition("gene").sortWithinPartitions("gene", "value")
    return dealt.mapInArrow(_pairs_of_batches, f"gene {gene}, a int, b int, {numbers}")


def _heavy_pairs(entries: DataFrame, names: Column) -> DataFrame:
    """The same of genes that are cut into value ranges."""
    of_gene = _gene_sums(entries).groupBy("gene").agg(F.collect_list("sums").alias("_parts"))
    listed = of_gene.withColumn("_codes", F.sequence(F.lit(1), F.size(names))).select(
        "gene",
        "_parts",
        F.transform(
            "_codes",
            lambda c: F.struct(c.alias("code"), *[_own_sum(s, c).alias(s) for s in ("nz", "x", "xx", "cubes")]),
        ).alias("_all"),
    )
    pairs = listed.withColumn("_a", F.explode("_all")).withColumn("_b", F.explode("_all"))
    a, b = F.col("_a.code"), F.col("_b.code")
    return pairs.select(
        "gene",
        (a - 1).alias("a"),
        (b - 1).alias("b"),
        *[F.col(f"_{side}.{c}").alias(f"{c}{i}") for i, side in enumerate("ab", 1) for c in ("nz", "x", "xx", "cubes")],
        *[_cross_sum(c, a, b).alias(c) for c in ("above", "level")],
        _cross_sum("twice", a, b).alias("twice12"),
        _cross_sum("twice", b, a).alias("twice21"),
    )


def _own_sum(name: str, code: Column) -> Column:
    """A region's sum over the value ranges of a gene; 0 where it has no entries."""

    def add(total: Column, part: Column) -> Column:
        return total + F.coalesce(F.get(part[name], F.array_position(part["codes"], code).cast("int") - 1), F.lit(0.0))

    return F.aggregate("_parts", F.lit(0.0), add)


def _cross_sum(name: str, a: Column, b: Column) -> Column:
    """A cross term of two regions over the value ranges of a gene; 0 where one has no entries."""

    def add(total: Column, part: Column) -> Column:
        i, j = (F.array_position(part["codes"], c).cast("int") for c in (a, b))
        held = F.when((i > 0) & (j > 0), F.get(part[name], (i - 1) * F.size(part["codes"]) + j - 1))
        return total + F.coalesce(held, F.lit(0.0))

    return F.aggregate("_parts", F.lit(0.0), add)


def _gene_sums(entries: DataFrame) -> DataFrame:
    """(gene, sums): own sums and cross terms of the regions with entries of a heavy gene.

    above = pairs of entries with a's value above b's, level = with equal values, twice =
    sum of n_a^2 n_b over common values, each as rows of a table codes x codes. A gene is
    cut into value ranges, each told what lies below it and passed in the order of its
    values; the terms of the ranges add up.
    """
    kinds = ["gene", "range", "code", "value", "n", "below"]
    ranged = entries.withColumn("range", value_bucket(F.col("value")).cast("long")).withColumn("below", F.lit(False)).select(*kinds)
    sums = cut_lineage(ranged.groupBy("gene", "range", "code").agg(F.sum("n").alias("n")))
    lower = sums.select("gene", F.col("range").alias("low"), "code", "n")
    told = sums.select("gene", "range").distinct().join(lower, "gene").filter("low < range")
    told = told.groupBy("gene", "range", "code").agg(F.sum("n").alias("n"))
    told = told.withColumn("value", F.lit(float("-inf"))).withColumn("below", F.lit(True))
    ranged = ranged.unionByName(told.select(*kinds))
    gene = entries.schema["gene"].dataType.simpleString()
    numbers = ", ".join(f"{c}: array<double>" for c in SUMS)
    dealt = ranged.repartition("gene", "range").sortWithinPartitions("gene", "range", "value")
    return dealt.mapInArrow(_sums_of_batches, f"gene {gene}, sums struct<codes: array<int>, {numbers}>")


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows come by gene, range and value; the last group of a batch may go on in the next."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        if not len(table):
            continue
        starts = _starts(table)
        rest = table.slice(starts[-1])
        yield table.slice(0, starts[-1]), starts
    if rest is not None and len(rest):
        yield rest, np.array([0, len(rest)])


def _sums_of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table, starts in _whole_groups(batches):
        yield from _sums_of_groups(table, starts)


def _pairs_of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table, starts in _whole_groups(batches):
        if not len(table):
            continue
        k = table.column("k")[0].as_py()
        codes, values, n = (table.column(c).to_numpy() for c in ("code", "value", "n"))
        genes = table.column("gene").combine_chunks().take(pa.array(starts[:-1]))
        step = max(1, DENSE // (k * k))
        for low in range(0, len(genes), step):
            cuts = starts[low : low + step + 1]
            some = slice(cuts[0], cuts[-1])
            own, cross = _dense_sums(codes[some] - 1, values[some], n[some], cuts - cuts[0], k)
            count = len(cuts) - 1
            pair = np.arange(count * k * k)
            g, a, b = pair // (k * k), pair // k % k, pair % k
            above, level, twice = cross
            columns = [o[g, side] for side in (a, b) for o in own]
            columns += [above.ravel(), level.ravel(), twice.ravel(), twice.transpose(0, 2, 1).ravel()]
            yield pa.RecordBatch.from_arrays(
                [genes.take(pa.array(g + low)), pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)), *map(pa.array, columns)],
                ["gene", "a", "b", *PAIRED],
            )


def _dense_sums(place: np.ndarray, values: np.ndarray, n: np.ndarray, starts: np.ndarray, k: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Own sums as tables genes x regions, and cross terms as tables genes x regions x regions."""
    genes = len(starts) - 1
    gene = np.repeat(np.arange(genes), np.diff(starts))
    at = gene * k + place
    own = [np.bincount(at, w, minlength=genes * k).reshape(genes, k) for w in (n, values * n, values * values * n, n * n * n)]
    cross = np.zeros((3, genes, k, k))
    if k > JOINT:
        for i, (start, stop) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)):
            there, *_, above, level, twice = _sums_of_gene(place[start:stop], values[start:stop], n[start:stop], np.zeros(stop - start, bool))
            for table, flat in zip(cross, (above, level, twice), strict=True):
                table[i][np.ix_(there, there)] = flat.reshape(len(there), len(there))
        return own, cross
    new = np.ones(len(gene), bool)
    new[1:] = (gene[1:] != gene[:-1]) | (values[1:] != values[:-1])
    row = np.cumsum(new) - 1  # a row for each value of a gene
    owner = gene[new]
    counts = np.zeros((len(owner), k))
    counts[row, place] = n  # a value and region is one entry
    total = np.cumsum(counts, axis=0)
    first = np.searchsorted(owner, np.arange(genes))
    lower = total - counts - (total[first] - counts[first])[owner]
    for a in range(k):
        mine = counts[:, a, None]
        cross[0, :, a] = np.add.reduceat(mine * lower, first)
        cross[1, :, a] = np.add.reduceat(mine * counts, first)
        cross[2, :, a] = np.add.reduceat(mine * mine * counts, first)
    return own, cross


def _starts(table: pa.Table) -> np.ndarray:
    """First rows of the groups of a table that is not empty."""
    new = np.zeros(len(table), bool)
    new[0] = True
    for name in ("gene", "range"):
        column = table.column(name).combine_chunks()
        here, before = column.slice(1), column.slice(0, len(column) - 1)
        both_null = pc.and_(here.is_null(), before.is_null())
        new[1:] |= pc.coalesce(pc.not_equal(here, before), pc.invert(both_null)).to_numpy(zero_copy_only=False)
    return np.flatnonzero(new)


def _sums_of_groups(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
    if not len(table):
        return
    columns = {c: table.column(c).to_numpy() for c in ("code", "value", "n", "below")}
    found = [
        _sums_of_gene(*(c[start:stop] for c in columns.values()))
        for start, stop in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)
    ]
    lists = []
    for own in zip(*found, strict=True):
        ends = np.cumsum([0, *map(len, own)]).astype(np.int32)
        lists.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(own))))
    genes = table.column("gene").combine_chunks().take(pa.array(starts[:-1]))
    yield pa.RecordBatch.from_arrays([genes, pa.StructArray.from_arrays(lists, ["codes", *SUMS])], ["gene", "sums"])


def _sums_of_gene(codes: np.ndarray, values: np.ndarray, n: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, ...]:
    """Codes and SUMS of one gene's entries in the order of values, some rows of values at a time."""
    present, place = np.unique(codes, return_inverse=True)
    k = len(present)
    low = np.bincount(place[below], n[below], minlength=k)
    if below.any():
        own = ~below
        place, values, n = place[own], values[own], n[own]
    sums = [np.bincount(place, w, minlength=k) for w in (n, values * n, values * values * n, n * n * n)]
    row = np.zeros(len(values), np.int64)
    np.cumsum(values[1:] != values[:-1], out=row[1:])
    rows = int(row[-1]) + 1 if len(row) else 0
    above, level, twice = np.zeros((3, k, k))
    step = max(1, DENSE // k)
    for at in range(0, rows, step):
        some = slice(*np.searchsorted(row, [at, at + step]))
        counts = np.zeros((min(step, rows - at), k))
        counts[row[some] - at, place[some]] = n[some]  # a value and region is one entry
        upto = np.cumsum(counts, axis=0) + low
        above += counts.T @ (upto - counts)
        level += counts.T @ counts
        twice += (counts * counts).T @ counts
        low = upto[-1]
    return present.astype(np.int32), *sums, above.ravel(), level.ravel(), twice.ravel()


def u_score(u: Column, n1: Column, n2: Column, ties: Column) -> Column:
    """Continuity-corrected z of the two-sided test with the tie correction."""
    total = n1 + n2
    best = F.greatest(u, n1 * n2 - u)
    spread = F.sqrt(
        n1 * n2 / 12 * ((total + 1) - F.try_divide(ties, total * (total - 1)))
    )
    return F.try_divide(best - n1 * n2 / 2 - 0.5, spread)


def compare_regions(
    expr: DataFrame,
    members: DataFrame,
    p_limit: float = 0.05,
    fold_limit: float = 3.0,
    compat: bool = True,
) -> DataFrame:
    """Full comparison: statistics, p-values, corrections, significance, direction."""
    stats = pairwise_statistics(expr, members, compat)
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    u_p = F.least(normal_two_sided(u_score(F.col("u"), n1, n2, F.col("ties"))), F.lit(1.0))
    tested = stats.select(
        "*",
        student_two_sided("t", n1 + n2 - 2).alias("t_pvalue"),
        F.coalesce(F.nanvl(u_p, F.lit(1.0)), F.lit(1.0)).alias("mw_pvalue"),
    )
    # Everything below reads the tested table several times; it is written once.
    tested = cut_lineage(tested)
    family = ["region_a", "region_b"]
    corrected = adjust_step_up(tested, family, "t_pvalue", "corrected_t_pvalue")
    corrected = adjust_step_up(corrected, family, "mw_pvalue", "corrected_mw_pvalue")
    significant = (F.col("corrected_t_pvalue") < p_limit) & (F.col("corrected_mw_pvalue") < p_limit)
    fc = F.col("fc")
    return corrected.withColumn("is_significant", significant).select(
        "*",
        F.when(F.col("is_significant") & (fc >= fold_limit), "upregulated")
        .when(F.col("is_significant") & (fc <= 1 / fold_limit), "downregulated")
        .otherwise("not significant")
        .alias("direction"),
        F.when(fc > 0, F.log2(fc)).alias("log2fc"),
        (-F.log10(F.when(F.col("corrected_t_pvalue") > 0, F.col("corrected_t_pvalue")))).alias(
            "neg_log10_pvalue"
        ),
    )
