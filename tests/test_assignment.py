from itertools import permutations

import numpy as np
import pandas as pd
import pytest

from spotloom.operators import annealing, assignment
from spotloom.operators.deconvolution import counts_from_abundance
from spotloom.operators.evaluation import _best_matching, match_instances, overlaps, panoptic_quality, jaccard_index


def test_transport_equals_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(30):
        gain = rng.random((3, 3))
        cells = rng.integers(0, 3, 6)
        types = rng.integers(0, 3, 6)
        supply = np.bincount(cells, minlength=3)
        demand = np.bincount(types, minlength=3)
        flow = assignment.best_transport(supply, demand, gain)
        assert (flow.sum(axis=1) == supply).all() and (flow.sum(axis=0) == demand).all()
        best = max(sum(gain[c, t] for c, t in zip(cells, p)) for p in set(permutations(types.tolist())))
        assert (flow * gain).sum() == pytest.approx(best)


def test_matching_equals_brute_force():
    rng = np.random.default_rng(1)
    for shape in ((3, 3), (2, 4), (4, 2)):
        for _ in range(20):
            gain = rng.random(shape) * (rng.random(shape) < 0.7)
            i, j = _best_matching(gain)
            assert len(set(i)) == len(i) and len(set(j)) == len(j)
            n = max(shape)
            square = np.zeros((n, n))
            square[: shape[0], : shape[1]] = gain
            best = max(square[range(n), list(p)].sum() for p in permutations(range(n)))
            assert gain[i, j].sum() == pytest.approx(best)


def test_instances_match_by_component(spark):
    rows = [(0, 1, 1, 0.6), (0, 1, 2, 0.5), (0, 2, 1, 0.5), (0, 3, 7, 0.9), (1, 1, 1, 0.2)]
    pairs = spark.createDataFrame(rows, "img long, true_id int, pred_id int, iou double")
    got = {(r.img, r.true_id, r.pred_id) for r in match_instances(pairs, "iou").collect()}
    assert got == {(0, 1, 2), (0, 2, 1), (0, 3, 7), (1, 1, 1)}


def test_perfect_masks_score_one(spark):
    rows = [(0, y, x, 1 + (x > 3), 5 + (x > 3)) for y in range(4) for x in range(8)]
    masks = spark.createDataFrame(rows, "img long, y int, x int, true_id int, pred_id int")
    pairs = overlaps(masks)
    assert jaccard_index(masks, pairs).first().aji == 1
    score = panoptic_quality(masks, pairs).first()
    assert score.dq == 1 and score.sq == pytest.approx(1, abs=1e-5)


def test_apportioned_counts_add_up(spark):
    abundance = spark.createDataFrame(
        [("s", "a", 0.5), ("s", "b", 0.3), ("s", "c", 0.05), ("e", "a", 0.01), ("z", "a", 2.0), ("z", "b", 2.0)],
        "barcode string, cell_type string, abundance double",
    )
    cells = spark.createDataFrame([("s", 7), ("z", 3), ("e", 0)], "barcode string, cell_n long")
    got = {(r.barcode, r.cell_type): r.n for r in counts_from_abundance(abundance, cells, 0.1).collect()}
    assert got == {("s", "a"): 4, ("s", "b"): 3, ("s", "c"): 0, ("z", "a"): 2, ("z", "b"): 1, ("e", "a"): 0}


def test_naive_deal_respects_counts(spark):
    cells = spark.createDataFrame([(i, "s" if i < 8 else "t") for i in range(10)], "cell_ids long, barcode string")
    counts = spark.createDataFrame([("s", "a", 3), ("s", "b", 2)], "barcode string, cell_type string, n long")
    got = assignment.naive_assignment(cells, counts).toPandas()
    dealt = got[got.barcode == "s"].cell_type.value_counts(dropna=False).to_dict()
    assert dealt == {"a": 3, "b": 2, None: 3}
    assert (got[got.barcode == "t"].cell_type == "not deconvolved").all()


def test_silhouette_does_not_depend_on_blocks(spark):
    rng = np.random.default_rng(2)
    rows = [(i, "s", [float(v) for v in rng.normal(i % 3, 1, 4)], i % 3) for i in range(40)]
    df = spark.createDataFrame(rows, "cell_ids long, barcode string, features array<double>, spot_clusters int")
    whole = {r.cell_ids: r.sil_score for r in assignment.silhouette(df).collect()}
    split = {r.cell_ids: r.sil_score for r in assignment.silhouette(df, block_rows=7).collect()}
    assert split == pytest.approx(whole)


def _blobs(n=30):
    rng = np.random.default_rng(3)
    return [(i, "s", [float(v) for v in rng.normal(4.0 * (i % 2), 0.5, 3)]) for i in range(n)]


def test_annealing_meets_capacities(spark):
    cells = spark.createDataFrame(_blobs() + [(99, "t", [0.0, 0.0, 0.0])], "cell_ids long, barcode string, features array<double>")
    counts = spark.createDataFrame([("s", "a", 20), ("s", "b", 10)], "barcode string, cell_type string, n long")
    got = annealing.local_assignment(cells, counts).toPandas()
    assert got[got.barcode == "s"].cell_type.value_counts().to_dict() == {"a": 20, "b": 10}
    assert (got[got.barcode == "t"].cell_type == "not deconvolved").all()


def test_crowded_spot_gives_the_same_labels(spark, monkeypatch):
    monkeypatch.setattr(annealing, "MAX_STEPS", 6)
    monkeypatch.setattr(annealing, "TEMPERATURES", [1.0])
    cells = spark.createDataFrame(_blobs(), "cell_ids long, barcode string, features array<double>")
    counts = spark.createDataFrame([("s", "a", 20), ("s", "b", 10)], "barcode string, cell_type string, n long")
    rows = [(r.cell_ids, r.features) for r in cells.collect()]
    crowded = annealing.local_assignment(cells, counts, max_rows=5)
    labels = {r.cell_ids: r.spot_clusters for r in crowded.collect()}
    from pyspark.sql import functions as F

    order = [r.cell_ids for r in cells.orderBy(F.xxhash64("cell_ids", F.lit(0)), "cell_ids").collect()]
    by_id = dict(rows)
    want = annealing.anneal(np.array([by_id[i] for i in order]), annealing._usable_share([20, 10], 30))
    assert [labels[i] for i in order] == want.tolist()


def test_spots_without_deconvolution_have_no_score(spark, monkeypatch):
    from spotloom import domain
    from spotloom.queries import assign

    cells = spark.createDataFrame(
        [(i, 1 + i // 4, "t", i % 2, 1.0) for i in range(8)],
        "cell_ids long, barcode long, cell_type string, cluster_name int, area double",
    )
    counts = spark.createDataFrame([(1, "a", 1), (1, "b", 2)], "barcode long, cell_type string, n long")
    monkeypatch.setattr(domain, "assigned", lambda *_: cells)
    monkeypatch.setattr(domain, "deconv", lambda *_: counts)
    for query in (assign.assign_allocation_score, assign.assign_global):
        assert [r.barcode for r in query(spark, "").collect()] == [1]


def test_tables_of_a_spot_equal_pivots():
    """Counts add up, probabilities of a cell of the table are averaged, missing ones are zero."""
    rng = np.random.default_rng(2)
    rows = pd.DataFrame(rng.integers(0, (5, 4, 3), (40, 3)), columns=["cluster_name", "cell_type", "w"])
    rows["p_combined"] = np.where(rng.random(40) < 0.2, np.nan, rng.random(40))
    clusters, row = np.unique(rows["cluster_name"], return_inverse=True)
    types, col = np.unique(rows["cell_type"], return_inverse=True)
    flow, gain = assignment._tables(rows, row, col, (len(clusters), len(types)))
    where = {"index": "cluster_name", "columns": "cell_type"}
    want = rows.pivot_table(**where, values="w", aggfunc="sum", fill_value=0)
    mean = rows.pivot_table(**where, values="p_combined", fill_value=0.0).reindex(index=want.index, columns=want.columns, fill_value=0.0)
    assert np.array_equal(flow, want) and np.allclose(gain, mean, rtol=1e-15, atol=0)
