import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from spotloom.functions.numeric import value_bucket
from spotloom.functions.ordering import running_sum
from spotloom.functions.probability import incomplete_beta
from spotloom.operators import comparative, graph, qc, variability


def test_running_sum_with_a_hot_key(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"k": np.where(rng.random(3000) < 0.5, 0, rng.integers(1, 9, 3000)), "v": rng.permutation(3000)})
    df = spark.createDataFrame(pdf)
    got = running_sum(df, ["k"], value_bucket(F.col("v")), [F.col("v")], F.col("v"), "upto", total="all").toPandas()
    want = pdf.sort_values("v")
    want["upto"] = want.groupby("k")["v"].cumsum()
    merged = got.merge(want, on=["k", "v"])
    assert (merged["upto_x"] == merged["upto_y"]).all()
    assert (got.groupby("k")["all"].first() == pdf.groupby("k")["v"].sum()).all()


def test_value_bucket_is_monotone(spark):
    values = [-1e9, -3.5, -1e-9, 0.0, 1e-9, 0.5, 1.0, 2.0, 255.0, 256.0, 1e12]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    codes = [r.c for r in df.select("v", value_bucket(F.col("v")).alias("c")).orderBy("v").collect()]
    assert codes == sorted(codes)


@pytest.mark.parametrize(
    "a,b,x,want", [(1, 1, 0.3, 0.3), (2, 3, 0.5, 0.6875), (0.5, 0.5, 0.5, 0.5), (5, 0.5, 0.5, 0.0124187)]
)
def test_incomplete_beta(a, b, x, want):
    # Closed forms; the last one is 1 - sqrt(1-x) times its polynomial.
    if (a, b) == (5, 0.5):
        t = np.linspace(0, x, 2_000_001)
        f = t**4 / np.sqrt(1 - t)
        norm = math.gamma(5) * math.gamma(0.5) / math.gamma(5.5)
        want = np.trapezoid(f, t) / norm
    assert abs(float(incomplete_beta(a, b, x)) - want) < 1e-8


def test_student_tail_known_values(spark):
    df = spark.createDataFrame([(2.0, 10.0), (1.0, 1.0), (0.0, 5.0), (None, 5.0)], "t double, df double")
    from spotloom.functions.probability import student_two_sided

    got = [r.p for r in df.select(student_two_sided("t", "df").alias("p")).collect()]
    assert got[0] == pytest.approx(0.0733880, abs=1e-6)
    assert got[1] == pytest.approx(0.5, abs=1e-9)
    assert got[2] == pytest.approx(1.0)
    assert got[3] is None


def test_step_up_by_hand(spark):
    df = spark.createDataFrame([(p,) for p in (0.01, 0.04, 0.03, 0.5, 0.04)] + [(None,)], "p double")
    got = sorted(r.q for r in comparative.adjust_step_up(df, [], "p", "q").collect())
    assert got == pytest.approx(sorted([0.06, 0.06, 0.06, 0.06, 0.6, 1.0]))


def test_pair_statistics_match_dense(spark):
    rng = np.random.default_rng(3)
    counts = rng.poisson(0.8, (9, 4))
    rows = [(i, f"g{j}", int(c)) for (i, j), c in np.ndenumerate(counts) if c]
    members = [(i, "a" if i < 4 else "b") for i in range(9)] + [(0, "b")]
    got = comparative.compare_regions(
        spark.createDataFrame(rows, "barcode int, gene string, count long"),
        spark.createDataFrame(members, "barcode int, region string"),
    ).toPandas()
    a, b = counts[:4], counts[[4, 5, 6, 7, 8, 0]]
    for j in range(4):
        row = got[(got.gene == f"g{j}") & (got.region_a == "a") & (got.region_b == "b")].iloc[0]
        x, y = a[:, j], b[:, j]
        u = sum((x[:, None] > y).ravel()) + 0.5 * sum((x[:, None] == y).ravel())
        pooled = ((x - x.mean()) @ (x - x.mean()) + (y - y.mean()) @ (y - y.mean())) / 8
        t = (x.mean() - y.mean()) / math.sqrt(pooled * (1 / 4 + 1 / 6))
        values, ties = np.unique(np.concatenate([x, y]), return_counts=True)
        assert row.u == u
        assert row.t == pytest.approx(t)
        assert row.ties == sum(ties**3 - ties)
    self_rows = got[got.region_a == got.region_b]
    assert (self_rows.direction == "not significant").all()


def test_qc_with_empty_spot_and_silent_gene(spark):
    expr = spark.createDataFrame(
        [("s1", "MT-A", 3), ("s1", "B", 1), ("s2", "B", 2)], "barcode string, gene string, count long"
    )
    spots = spark.createDataFrame(
        [(s, 1, 0, 0, n) for s, n in (("s1", 4), ("s2", 0), ("s3", 1))],
        "barcode string, in_tissue int, pxl_row_in_fullres int, pxl_col_in_fullres int, num_contained_cells long",
    )
    genes = spark.createDataFrame([(g, g) for g in ("MT-A", "B", "C", "D")], "gene string, gene_name string")
    got = {r.barcode: r for r in qc.spot_qc(expr, spots, genes, ["mt-"]).collect()}
    assert got["s1"].qc_nGenes == 2 and got["s1"].qc_nCounts == 4
    assert got["s1"].qc_mitochondrial_genes_n == 1 and got["s1"].qc_mitochondrial_genes_cts == 3
    assert got["s1"].qc_GeneSaturation == 0.5
    assert got["s3"].qc_nGenes == 0 and got["s3"].qc_CountByGene is None
    assert got["s3"].qc_mitochondrial_genes_n == 0
    by_gene = {r.gene: r for r in qc.gene_qc(expr, spots, genes, ["mt-"]).collect()}
    assert by_gene["MT-A"].qc_mitochondrial_genes and not by_gene["B"].qc_mitochondrial_genes
    overall = qc.overall_qc(expr, "e").first()
    assert overall.qc_Library_size == sum(r.qc_nCounts for r in got.values()) == 6


HEXAGON = [("c", 2, 2), ("w", 2, 0), ("e", 2, 4), ("nw", 1, 1), ("ne", 1, 3), ("sw", 3, 1), ("se", 3, 3)]


def test_hexagon_degrees_and_moran(spark):
    spots = spark.createDataFrame(HEXAGON, "barcode string, array_row int, array_col int")
    edges = graph.lattice_edges(spots, 1)
    degree = {r.src: r.degree for r in graph.degrees(edges).collect()}
    assert degree.pop("c") == 6 and set(degree.values()) == {3}
    x = {"c": 5.0, "w": 1.0, "e": 2.0, "ne": 4.0}
    values = spark.createDataFrame([(k, "m", v) for k, v in x.items()], "barcode string, marker string, value double")
    got = graph.morans_i(values, edges, F.lit(7)).first()
    names = [h[0] for h in HEXAGON]
    w = np.zeros((7, 7))
    for r in edges.collect():
        w[names.index(r.src), names.index(r.dst)] = 1
    w /= w.sum(axis=1, keepdims=True)
    z = np.array([x.get(n, 0.0) for n in names])
    z = z - z.mean()
    assert got.I == pytest.approx((z @ w @ z) / (z @ z))
    shifted = spark.createDataFrame(
        [(n, "m", 3 * x.get(n, 0.0) + 2) for n in names], "barcode string, marker string, value double"
    )
    assert graph.morans_i(shifted, edges, F.lit(7)).first().I == pytest.approx(got.I)
    constant = spark.createDataFrame([(n, "m", 2.0) for n in names], "barcode string, marker string, value double")
    assert graph.morans_i(constant, edges, F.lit(7)).first().I is None


def test_exact_enrichment_agrees_with_permutations(spark):
    rows = [(f"{r}-{c}", r, c, "ab"[(r + c) // 2 % 2] if r < 5 else "c") for r in range(8) for c in range(r % 2, 16, 2)]
    spots = spark.createDataFrame(rows, "barcode string, array_row int, array_col int, label string")
    edges = graph.lattice_edges(spots, 1)
    labels = spots.select(F.col("barcode").alias("id"), "label")
    exact = {(r.type_a, r.type_b): r.zscore for r in graph.neighbourhood_enrichment(edges, labels).collect()}
    drawn = {(r.type_a, r.type_b): r.zscore for r in graph.permuted_enrichment(edges, labels, 400).collect()}
    for pair, z in drawn.items():
        assert z == pytest.approx(exact[pair], abs=0.15 * abs(exact[pair]) + 0.3)


def _written(spark):
    """Rows written to shuffles so far."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    store = spark.sparkContext._jsc.sc().statusStore()
    none = jvm.java.util.ArrayList()
    stages = store.stageList(none, False, False, gateway.new_array(gateway.jvm.double, 0), none)
    return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))


def test_permuted_enrichment_makes_no_row_for_a_vertex_and_a_trial(spark):
    """Counts follow Spark's hashes of (id, seed, trial); what is shuffled does not hold the draws."""
    rng = np.random.default_rng(3)
    n, trials = 400, 70
    kinds = [None if k == 3 else "abc"[k] for k in rng.integers(0, 4, n).tolist()]
    ends = rng.integers(0, n + 5, (900, 2))  # some ends have no label row
    labels = spark.createDataFrame([(f"v{i}", k) for i, k in enumerate(kinds)], "id string, label string")
    edges = spark.createDataFrame([(f"v{a}", f"v{b}") for a, b in ends.tolist()], "src string, dst string")
    before = _written(spark)
    rows = graph.permuted_enrichment(edges, labels, trials, 5).collect()
    assert _written(spark) - before < 60 * n
    hashes = labels.crossJoin(spark.range(trials + 1).select(F.col("id").cast("int").alias("t"))).select(
        "id", "t", F.xxhash64("id", F.lit(5), "t").alias("h")
    )
    order = [[] for _ in range(trials + 1)]
    for r in sorted(hashes.collect(), key=lambda r: r.h):
        order[r.t].append(int(r.id[1:]))
    counts = {}
    for t in range(trials + 1):
        label = {v: kinds[w] for v, w in zip(order[0], order[t], strict=True)}
        for a, b in ends.tolist():
            if a < n and b < n:
                counts.setdefault((label[a], label[b]), np.zeros(trials + 1))[t] += 1
    assert {(r.type_a, r.type_b): r.n_edges for r in rows} == {k: v[0] for k, v in counts.items()}
    for r in rows:
        seen = counts[r.type_a, r.type_b]
        assert r.zscore == pytest.approx((seen[0] - seen[1:].mean()) / seen[1:].std())


@pytest.mark.parametrize(("markers", "groups"), [(300, 3), (1, 8), (40, 1)])
def test_permuted_moran_makes_no_row_for_an_entry_and_a_draw(spark, markers, groups):
    rng = np.random.default_rng(markers)
    n, trials = 45, 60
    ends = rng.integers(0, n + 3, (200, 2))  # three ends are no spots, and not all spots have neighbours
    ends = ends[(ends[:, 0] < n - 2) & (ends[:, 0] != ends[:, 1])]
    spots = spark.createDataFrame([(f"s{i}",) for i in range(n)], "barcode string")
    edges = spark.createDataFrame([(f"s{a}", f"s{b}") for a, b in ends.tolist()], "src string, dst string")
    x = np.where(rng.random((markers, n + 5)) < 0.8, rng.integers(1, 9, (markers, n + 5)), 0)
    rows = [(f"s{i}", f"m{k:03}", int(x[k, i])) for k, i in zip(*np.nonzero(x), strict=True)]
    values = spark.createDataFrame(rows, "barcode string, marker string, value int").repartition(4)
    before = _written(spark)
    got = {r.marker: r.pval_sim for r in graph.permuted_morans_i(values, edges, spots, trials, 1, groups).collect()}
    assert _written(spark) - before < len(rows) * 4 + n * (8 * trials + 30 * groups) + 5000
    w = np.zeros((n, n + 5))
    np.add.at(w, (ends[:, 0], ends[:, 1]), 1.0)
    w /= np.maximum(w.sum(axis=1, keepdims=True), 1)
    hashes = spots.crossJoin(spark.range(trials + 1).select(F.col("id").cast("int").alias("t"))).select(
        "barcode", "t", F.xxhash64("barcode", F.lit(1), "t").alias("h")
    )
    order = [[] for _ in range(trials + 1)]
    for r in sorted(hashes.collect(), key=lambda r: r.h):
        order[r.t].append(int(r.barcode[1:]))
    for k in range(markers):
        lag, has, mean = w @ x[k], w.sum(axis=1), x[k].sum() / n

        def stat(to, of, v=x[k]):
            return round(float(v[to] @ lag[of] - mean * (v[to] @ has[of])), 9)

        seen = stat(order[0], order[0])
        ge = sum(stat(order[0], order[t]) >= seen for t in range(1, trials + 1))
        assert got[f"m{k:03}"] == (min(ge, trials - ge) + 1) / (trials + 1)


def test_permuted_moran_makes_no_row_for_a_spot_and_a_draw(spark):
    n, trials = 300, 150
    spots = spark.range(n).select(F.col("id").alias("barcode"))
    edges = spots.select(F.col("barcode").alias("src"), ((F.col("barcode") + 1) % n).alias("dst"))
    values = spots.select("barcode", (F.col("barcode") % 7).alias("marker"), F.lit(2).alias("value"))
    before = _written(spark)
    assert graph.permuted_morans_i(values, edges, spots, trials, 1, 4).count() == 7
    assert _written(spark) - before < n * 60


def test_lags_of_many_spots_are_solved_together(monkeypatch):
    """Few passes however many spots there are, and what a table of all lags gives."""
    import pyarrow as pa

    rng = np.random.default_rng(6)
    n, markers = 60_000, 400
    heads = [rng.integers(0, n, 6).astype(np.int32).tobytes() for _ in range(n)]
    rows = pa.table({"spot": np.arange(n, dtype=np.int32), "base": rng.integers(-(2**62), 2**62, n), "heads": pa.array(heads, pa.binary()), "degree": np.full(n, 6)})
    draws = graph._Draws(rows, 20)
    marker = np.sort(rng.integers(0, markers, 4000))
    spot = rng.integers(0, n, 4000)
    spot[:2000:2] = np.frombuffer(b"".join(heads), np.int32).reshape(n, 6)[spot[1:2000:2], 0]  # lags meet entries
    value = rng.integers(1, 9, 4000).astype(float)
    passes, some = [], graph._Draws._some
    monkeypatch.setattr(graph._Draws, "_some", lambda *args: passes.append(args[-1]) or some(*args))
    got, want = np.empty((2, markers), np.int64)
    draws.larger(marker, spot, value, got)
    assert sum(passes) == markers and len(passes) < 20
    for k in range(markers):
        here = marker == k
        want[k] = draws._some(np.zeros(here.sum(), np.int64), spot[here], value[here], 1)[0]
    assert (got == want).all() and got.min() == 0 < got.max()


def test_trials_are_counted_over_one_row_an_edge():
    import pyarrow as pa

    rng = np.random.default_rng(2)
    kinds, trials, edges = 4, 7, 600
    a, b = (rng.integers(1, kinds + 1, (edges, trials)) for _ in range(2))
    want = {}
    for x, y in zip(a, b):
        for t in range(trials):
            key = (t, x[t] - 1, y[t] - 1)
            want[key] = want.get(key, 0) + 1
    listed = [pa.array(list(v.astype(np.int16)), pa.list_(pa.int16())) for v in (a, b)]
    batch = pa.RecordBatch.from_arrays([*listed, pa.array([kinds] * edges, pa.int32())], ["a", "b", "kinds"])
    got = [r for out in graph._count_trials(iter([batch.slice(0, 300), batch.slice(300)])) for r in out.to_pylist()]
    assert {(r["trial"], r["a"], r["b"]): r["n"] for r in got} == want


def test_planted_gene_is_spatially_variable(spark):
    rng = np.random.default_rng(1)
    spots, expr = [], []
    for i in range(100):
        x, y = i % 10, i // 10
        spots.append((0, i, float(x), float(y)))
        for g in range(8):
            rate = 40 * math.exp(-((x - 3) ** 2 + (y - 3) ** 2) / 8) + 3 if g == 0 else 8
            count = int(rng.poisson(rate))
            if count:
                expr.append((i, g, count))
    result = variability.spatial_variability(
        spark.createDataFrame(expr, "barcode int, gene int, count long"),
        spark.createDataFrame(spots, "exp_id int, barcode int, x double, y double"),
    ).toPandas()
    best = result.sort_values("LLR").iloc[-1]
    assert best.gene == 0 and best.pval < 1e-4 and best.FSV > 0.3
    assert result[result.gene != 0].LLR.max() < best.LLR / 3


def test_noise_ratios_are_found_in_few_passes(monkeypatch):
    rng = np.random.default_rng(4)
    xy = np.array([(i % 8, i // 8) for i in range(64)], float)
    square = ((xy[:, None] - xy[None]) ** 2).sum(axis=2)
    y = rng.normal(size=(20, 64)) + 50 + 3 * np.exp(-square[rng.integers(0, 64, 20)] / 8) * rng.random((20, 1))
    passes = []
    whole = variability._log_likelihood
    monkeypatch.setattr(variability, "_log_likelihood", lambda *args: passes.append(1) or whole(*args))
    s, u, gower = variability._decomposed(np.exp(-square / 18))
    ll, fsv = variability._fit(y, s, u, gower)
    assert len(passes) <= 33
    fine = np.linspace(-10, 20, 3001)
    values = np.stack([whole(np.full(20, g), s, (u.sum(axis=0), y @ u), 64) for g in fine], axis=1)
    assert ll == pytest.approx(values.max(axis=1), abs=2e-3)
    assert fsv == pytest.approx(gower / (gower + np.exp(fine[values.argmax(axis=1)])), abs=0.02)


def test_moving_average_over_several_levels(spark):
    from spotloom.operators.history import moving_average

    rng = np.random.default_rng(9)
    x = rng.random(70)
    df = spark.createDataFrame([("a", i, float(v)) for i, v in enumerate(x)], "k string, s long, v double")
    got = moving_average(df, "k", "s", "v", alpha=0.9, block=3, levels=3).orderBy("s").toPandas()["ema"]
    want = [x[0]]
    for v in x[1:]:
        want.append(0.9 * want[-1] + 0.1 * v)
    assert got.to_numpy() == pytest.approx(np.array(want))


def test_tables_of_many_genes_are_filled_together(monkeypatch):
    """One pass for a batch of genes gives what a pass for each gene gives, without calling it."""
    from spotloom.operators import comparative

    rng = np.random.default_rng(3)
    rows = sorted({(int(g), float(v), int(r)) for g, v, r in rng.integers(0, (30, 6, 4), (900, 3))})
    gene, values, place = (np.array(c) for c in zip(*rows, strict=True))
    n = rng.integers(1, 5, len(rows)).astype(float)
    starts = np.append(np.searchsorted(gene, np.unique(gene)), len(gene))
    want_own, want = np.zeros((4, 30, 4)), np.zeros((3, 30, 4, 4))
    for i, (a, b) in enumerate(zip(starts[:-1], starts[1:], strict=True)):
        there, *sums = comparative._sums_of_gene(place[a:b], values[a:b], n[a:b], np.zeros(b - a, bool))
        for table, flat in zip(want_own, sums[:4], strict=True):
            table[i][there] = flat
        for table, flat in zip(want, sums[4:], strict=True):
            table[i][np.ix_(there, there)] = flat.reshape(len(there), -1)
    monkeypatch.setattr(comparative, "JOINT", 0)
    assert all(map(np.array_equal, comparative._dense_sums(place, values, n, starts, 4), (want_own, want)))
    monkeypatch.setattr(comparative, "JOINT", 16)
    monkeypatch.setattr(comparative, "_sums_of_gene", None)
    own, cross = comparative._dense_sums(place, values, n, starts, 4)
    assert np.array_equal(own, want_own) and np.array_equal(cross, want)


@pytest.mark.parametrize("light, dense", [(10_000, 1 << 20), (5, 7)])
def test_rank_sums_of_present_and_absent_regions(spark, monkeypatch, light, dense):
    """Also with genes cut into value ranges and tables of a few rows at a time."""
    import random

    from spotloom.operators import comparative

    monkeypatch.setattr(comparative, "LIGHT_ROWS", light)
    monkeypatch.setattr(comparative, "DENSE", dense)
    draw = random.Random(4)
    members = [(i, f"r{i % 4}") for i in range(80)] + [(99, "lonely")]
    values = {"g0": [1, 2, 3], "g1": [0.5, 1.5, 700.0], "g2": [2], None: [1, 9]}
    counts = {}
    for gene, some in values.items():
        for i in range(100):
            if draw.random() < 0.6 and not (gene == "g2" and i % 4 != 1):
                counts[i, gene] = float(draw.choice(some))
    expr = spark.createDataFrame([(i, g, v) for (i, g), v in counts.items()], "barcode int, gene string, count double")
    got = comparative.pair_sums(
        comparative.region_histogram(expr, spark.createDataFrame(members, "barcode int, region string")),
        comparative.region_sizes(spark.createDataFrame(members, "barcode int, region string")),
    ).collect()
    assert len(got) == len(values) * 16
    for r in got:
        a, b = ([counts.get((i, r["gene"]), 0.0) for i, region in members if region == r[side]] for side in ("region_a", "region_b"))
        u = sum(1.0 if x > y else 0.5 if x == y else 0.0 for x in a for y in b)
        both = a + b
        ties = sum(both.count(v) ** 3 - both.count(v) for v in set(both))
        assert (r["n1"], r["n2"], r["u"], r["ties"]) == (len(a), len(b), u, ties)
        assert abs(r["x1"] - sum(a)) < 1e-9 and abs(r["xx2"] - sum(y * y for y in b)) < 1e-6
