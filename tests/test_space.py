import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spotloom.functions import geometry as geo
from spotloom.operators import components, cooccurrence, spatial
from spotloom.operators.components import contract_labels, convex_areas, hull_features, mask_components, mask_rings
from spotloom.operators import delaunay
from spotloom.operators.delaunay import circles, delaunay_edges, flat, triangulate

SQUARE = [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)]
ELL = [(0.0, 0.0), (10.0, 0.0), (10.0, 4.0), (4.0, 4.0), (4.0, 10.0), (0.0, 10.0)]


def _regions(spark, **rings):
    rows = [("k", name, [{"x": x, "y": y} for x, y in ring]) for name, ring in rings.items()]
    return spark.createDataFrame(
        rows, "region_class string, region_name string, ring array<struct<x double, y double>>"
    )


def test_membership_on_edges_and_corners(spark):
    points = {1: (5, 5), 2: (0, 5), 3: (10, 10), 4: (3, 9), 5: (6, 6), 6: (4, 7), 7: (-1, 2), 8: (9.5, 3.5)}
    cells = spark.createDataFrame([(k, float(x), float(y)) for k, (x, y) in points.items()], "cell_ids int, cell_x double, cell_y double")
    for closed in (False, True):
        rings = {"square": SQUARE, "ell": ELL}
        if closed:
            rings = {k: v + v[:1] for k, v in rings.items()}
        hits = spatial.region_members(cells, _regions(spark, **rings), "cell_ids", "cell_x", "cell_y", unit=4.0)
        got = {(r.region_name, r.cell_ids) for r in hits.collect()}
        assert got == {("square", i) for i in (1, 4, 5, 6, 8)} | {("ell", 4), ("ell", 8)}
    edges = geo.ring_edges(F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ELL]))
    inside = cells.filter(geo.contains(edges, F.col("cell_x"), F.col("cell_y")))
    assert {r.cell_ids for r in inside.collect()} == {4, 8}


def test_infiltration_levels_of_a_square(spark):
    points = {
        1: (5, 5), 2: (5, 1), 3: (5, -1), 4: (5, -2), 5: (5, 0), 6: (5, -3.5), 7: (12, 12),
        8: (11.2, 11.2), 9: (5, -9), 10: (13, 13),
    }
    cells = spark.createDataFrame(
        [(k, float(x), float(y), "t") for k, (x, y) in points.items()],
        "cell_ids int, cell_x double, cell_y double, cell_type string",
    )
    def levels(style):
        rows = spatial.infiltration_levels(cells, _regions(spark, s=SQUARE), 2, 3, style, unit=4.0).collect()
        return {r.cell_ids: r.infilt_level for r in rows}

    got = levels("bevel")
    # Five deep is past the second inner buffer; on a boundary a cell is outside it.
    assert got[1] == -4 and got[2] == 0 and got[3] == 2 and got[4] == 4 and got[5] == 2 and got[6] == 4
    assert 9 not in got
    # Corner (2, 2) away: round distance 2.83; bevelled buffers need 2 * 4 / 2 = 4.
    assert got[7] == 6 and levels("round")[7] == 4
    # (3, 3): bevel needs width 6, which is outside the outermost buffer.
    assert 10 not in got and levels("round")[10] == 6
    assert got[8] == 4


def test_spot_polygon_is_the_inscribed_polygon(spark):
    df = spark.createDataFrame([(31.9, 0.0), (0.0, -31.99), (32.0, 0.0), (22.6, 22.6), (31.95, 1.5)], "dx double, dy double")
    got = [r.c for r in df.select(geo.in_buffered_point(F.col("dx"), F.col("dy"), 32.0).alias("c")).collect()]
    edge = 32 * math.cos(math.pi / 64)
    want = []
    for dx, dy in [(31.9, 0.0), (0.0, -31.99), (32.0, 0.0), (22.6, 22.6), (31.95, 1.5)]:
        t = math.atan2(dy, dx) % (math.pi / 32) - math.pi / 64
        want.append(math.hypot(dx, dy) * math.cos(t) < edge - 1e-9)
    assert got == want == [True, True, False, True, False]


def test_boxes_of_very_different_sizes(spark):
    rng = np.random.default_rng(2)
    points = rng.uniform(0, 1000, (400, 2))
    sides = [1.0, 8.0, 60.0, 900.0]
    boxes = [(i, *(c := rng.uniform(0, 1000, 2)), c[0] + sides[i % 4], c[1] + sides[i % 4]) for i in range(40)]
    p = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(points)], "p int, x double, y double")
    b = spark.createDataFrame([tuple(map(float, v)) for v in boxes], "b double, _x0 double, _y0 double, _x1 double, _y1 double")
    got = {(r.p, int(r.b)) for r in spatial.box_join(p, b, "x", "y", 4.0).select("p", "b").collect()}
    want = {
        (i, k) for i, (x, y) in enumerate(points) for k, x0, y0, x1, y1 in boxes if x0 <= x <= x1 and y0 <= y <= y1
    }
    assert got == want


def test_overlapping_spots_later_wins(spark):
    cells = spark.createDataFrame([(1, 10.0, 10.0), (2, 100.0, 100.0), (3, 14.0, 10.0)], "cell_ids int, cell_x double, cell_y double")
    spots = spark.createDataFrame(
        [("a", 10, 8, 1), ("b", 10, 12, 2)],
        "barcode string, pxl_row_in_fullres int, pxl_col_in_fullres int, place int",
    )
    got = {r.cell_ids: r.barcode for r in spatial.assign_cells_to_spots(cells, spots, 5.0, "place").collect()}
    assert got == {1: "b", 2: None, 3: "b"}


def test_cooccurrence_with_small_blocks(spark):
    rng = np.random.default_rng(4)
    xy = rng.integers(0, 300, (220, 2)).astype(float)
    xy[:80] = rng.integers(0, 6, (80, 2))
    types = np.array(["a", "b", "c"])[rng.integers(0, 3, 220)]
    limits = [0, 3, 27, 125, 400]
    df = spark.createDataFrame(
        [(i, float(x), float(y), str(t)) for i, ((x, y), t) in enumerate(zip(xy, types))],
        "cell_ids int, cell_x double, cell_y double, cell_type string",
    )
    for reach in (limits, limits[:3]):
        got = {
            (r.band, r.type_a, r.type_b): r.n
            for r in cooccurrence.pair_counts(df, ["a", "b", "c"], reach, tile=16.0, block_rows=10).collect()
        }
        gap = np.hypot(*(xy[:, None, :] - xy[None]).transpose(2, 0, 1))
        want = {}
        for band, (lo, hi) in enumerate(zip(reach, reach[1:])):
            for i, j in zip(*np.nonzero((gap > lo) & (gap <= hi))):
                key = (band, types[i], types[j])
                want[key] = want.get(key, 0) + 1
        assert got == want


def test_cooccurrence_sends_blocks_once_a_group(spark, monkeypatch):
    rng = np.random.default_rng(7)
    xy = np.unique(rng.integers(0, 400, (900, 2)), axis=0).astype(float)
    types = np.array(["a", "b"])[rng.integers(0, 2, len(xy))]
    df = spark.createDataFrame(
        [(i, float(x), float(y), str(t)) for i, ((x, y), t) in enumerate(zip(xy, types))],
        "cell_ids int, cell_x double, cell_y double, cell_type string",
    )
    sent = []
    spread_by = cooccurrence.spread_by
    monkeypatch.setattr(cooccurrence, "spread_by", lambda d, *k, **o: sent.append(d) or spread_by(d, *k, **o))
    limits = [0, 30, 60, 90, 120, 600]
    got = {(r.band, r.type_a, r.type_b): r.n for r in cooccurrence.pair_counts(df, None, limits, tile=32.0, block_rows=16).collect()}
    gap = np.hypot(*(xy[:, None, :] - xy[None]).transpose(2, 0, 1))
    want = {
        (k, a, b): int(((gap > lo) & (gap <= hi))[types == a][:, types == b].sum())
        for k, (lo, hi) in enumerate(zip(limits, limits[1:])) for a in "ab" for b in "ab"
    }
    assert got == want
    blocks = 900 / 16  # at least; every two of them are within reach
    assert sent[0].count() < blocks * blocks / 8


def test_blocks_apart_measure_few_pairs(monkeypatch):
    """Counts of pairs by band are exact, lattice distances on a limit among them; few distances are taken."""
    rng = np.random.default_rng(11)
    limits = np.array([0.0, 5.0, 60.0, 100.0, 130.0, 131.0, 250.0, 300.0])
    bands, measured, squares = cooccurrence.Bands(limits), [], cooccurrence._squares
    monkeypatch.setattr(cooccurrence, "_squares", lambda dx, dy: measured.append(dx.size) or squares(dx, dy))
    apart = 0
    for case in range(60):
        sizes = rng.integers(1, 400, 2)
        at = rng.choice([40, 90, 200]) * np.array([np.cos(case), np.sin(case)])
        sides = [rng.choice([1, 9, 50], 2) for _ in range(2)]
        xy = [rng.uniform(0, 1, (n, 2)) * side + (at if i else 0) for i, (n, side) in enumerate(zip(sizes, sides, strict=True))]
        if case % 2:
            xy = [np.round(v) for v in xy]
        left, right = ((v[:, 0].copy(), v[:, 1].copy(), rng.integers(0, 3, len(v)).astype(np.int32)) for v in xy)
        seen = cooccurrence.Seen(left, right)
        if not seen.apart():
            continue
        apart += 1
        got = cooccurrence._measure_apart(left, right, seen, bands, 3)
        up = np.ceil(np.sqrt((left[0][:, None] - right[0]) ** 2 + (left[1][:, None] - right[1]) ** 2))
        for k in range(bands.n):
            hit = (up > limits[k]) & (up <= limits[k + 1])
            want = np.zeros((3, 3), np.int64)
            np.add.at(want, (left[2][np.nonzero(hit)[0]], right[2][np.nonzero(hit)[1]]), 1)
            assert (got[k] == want).all()
    assert apart > 30
    measured.clear()
    left, right = ((rng.uniform(0, 600, 4096), rng.uniform(0, 600, 4096) + y, rng.integers(0, 3, 4096).astype(np.int32)) for y in (0, 5000))
    cooccurrence._measure_apart(left, right, cooccurrence.Seen(left, right), cooccurrence.Bands(np.array([0.0, 4900.0, 5000.0])), 3)
    assert sum(measured) < 2 * 4096 * 4096 / 50


def test_triangulation_has_empty_circles():
    rng = np.random.default_rng(5)
    for n, side in ((6, 3), (60, 12), (400, 4000)):
        xy = np.unique(rng.integers(0, side, (n, 2)).astype(float), axis=0)
        tri = triangulate(xy)
        solid = tri[tri[:, 2] >= 0]
        hull = (tri[:, 2] < 0).sum()
        assert len(solid) == 2 * len(xy) - 2 - hull
        cx, cy, r = circles(xy, solid)
        gap = np.hypot(xy[:, 0] - cx[:, None], xy[:, 1] - cy[:, None])
        assert not (gap < r[:, None] * (1 - 1e-7)).any()


def test_edges_of_pairs_are_folded_without_a_sort(spark):
    """Levels hash the edges of a pair together, and cells of both slides are dealt over the tasks."""
    from spotloom.queries import QUERIES

    cells = spark.createDataFrame([(1, 5.0, 5.0, "t")], "cell_ids int, cell_x double, cell_y double, cell_type string")
    levels = spatial.infiltration_levels(cells, _regions(spark, s=SQUARE), 2, 3, unit=4.0)
    plan = levels._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
    plan = QUERIES["slides_region_cells"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan


def test_triangulation_tests_few_circles_a_point(monkeypatch):
    """Only circles next to the new point are tested, not those of all triangles that may still change."""
    asked = []
    plain = delaunay._Signs.in_circle

    def counted(self, *corners_and_p):
        asked.append(len(corners_and_p[0]) if np.ndim(corners_and_p[0]) else 1)
        return plain(self, *corners_and_p)

    monkeypatch.setattr(delaunay._Signs, "in_circle", counted)
    xy = np.unique(np.random.default_rng(5).random((1500, 2)), axis=0)
    triangulate(xy)
    assert sum(asked) < 40 * len(xy)


def test_tiled_delaunay_equals_one_triangulation(spark):
    rng = np.random.default_rng(6)
    xy = np.unique(np.concatenate([rng.integers(0, 2000, (500, 2)), rng.integers(400, 440, (250, 2))]).astype(float), axis=0)
    want = set()
    for a, b, c in triangulate(xy):
        if c >= 0:
            want |= {tuple(sorted(map(int, e))) for e in ((a, b), (b, c), (c, a))}
    df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(xy)], "id long, x double, y double")
    got = {(r.src, r.dst) for r in delaunay_edges(df, tile_cap=300, last_cap=400).collect() if r.src < r.dst}
    assert got == want


def test_plans_do_not_grow_with_the_grids_of_empty_circles(spark, monkeypatch):
    rng = np.random.default_rng(8)
    xy = rng.uniform(0, 4096, (60, 2))
    cells = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(xy)], "id long, x double, y double")
    circles_ = [(i, i + 1, i + 2, float(x), float(y), float(r)) for i, (x, y, r) in enumerate(zip(*rng.uniform(0, 4096, (2, 40)), 2.0 ** rng.uniform(-3, 12, 40)))]
    found = spark.createDataFrame(circles_, "a long, b long, c long, cx double, cy double, r double")
    leaves, joined = [], delaunay.box_join

    def box_join(points, boxes, *more, **named):
        leaves.append(boxes._jdf.queryExecution().analyzed().collectLeaves().size())
        return joined(points, boxes, *more, **named)

    monkeypatch.setattr(delaunay, "box_join", box_join)
    got = {r.a for r in delaunay._empty_circles(found, cells, 4.0, 4096.0).collect()}
    gap = np.hypot(*(xy[None] - np.array(circles_)[:, None, 3:5]).transpose(2, 0, 1))
    inside = (gap < np.array(circles_)[:, 5:]) & ((np.arange(60) < np.arange(40)[:, None]) | (np.arange(60) > np.arange(40)[:, None] + 2))
    assert got == set(np.flatnonzero(~inside.any(axis=1)).tolist()) and 0 < len(got) < 40
    assert len(leaves) == 6 and max(leaves) <= 2


def _flood(grid, diagonal):
    label = np.zeros(grid.shape, dtype=int)
    steps = [(0, 1), (1, 0), (0, -1), (-1, 0)] + ([(1, 1), (1, -1), (-1, 1), (-1, -1)] if diagonal else [])
    count = 0
    for y, x in zip(*np.nonzero(grid)):
        if label[y, x]:
            continue
        count += 1
        stack = [(y, x)]
        label[y, x] = count
        while stack:
            cy, cx = stack.pop()
            for dy, dx in steps:
                ny, nx = cy + dy, cx + dx
                if 0 <= ny < grid.shape[0] and 0 <= nx < grid.shape[1] and not label[ny, nx] and grid[ny, nx] == grid[cy, cx]:
                    label[ny, nx] = count
                    stack.append((ny, nx))
    return label


@pytest.mark.parametrize("diagonal", [False, True])
def test_components_across_tiles(spark, diagonal):
    rng = np.random.default_rng(7)
    grid = rng.integers(0, 3, (24, 24)) * (rng.random((24, 24)) < 0.9)
    rows = [(0, int(y), int(x), int(grid[y, x])) for y, x in zip(*np.nonzero(grid))]
    df = spark.createDataFrame(rows, "img long, y int, x int, inst_id int")
    got = mask_components(df, diagonal, tile=5).collect()
    label = _flood(grid, diagonal)
    pairs = {(r.component, int(label[r.y, r.x])) for r in got}
    assert len(pairs) == len({p[0] for p in pairs}) == len({p[1] for p in pairs}) == label.max()


def test_outline_of_an_l_shape(spark):
    rows = [(0, y, x, 1) for y in range(3) for x in range(3) if y == 2 or x == 0]
    df = spark.createDataFrame(rows, "img long, y int, x int, inst_id int")
    text = mask_rings(df, tile=2).first().polygon
    ring = geo.parse_wkt_ring(F.lit(text))
    area = df.select(F.abs(geo.signed_area(geo.ring_edges(ring))).alias("a")).first().a
    assert area == len(rows)


def _walked(cells):
    """Outer ring of a 4-connected set of (y, x), one side at a time, straight runs joined."""
    moves = [(1, 0), (0, 1), (-1, 0), (0, -1)]
    y, x = min(cells)
    at, way, ring = (x, y), 0, [(x, y)]
    while True:
        at = (at[0] + moves[way][0], at[1] + moves[way][1])
        # The pixel on the inner hand and the one across, ahead of the corner.
        (dx, dy), (ex, ey) = moves[way], moves[(way + 1) % 4]
        ahead = [(int(at[1] + (dy + side * ey - 1) / 2), int(at[0] + (dx + side * ex - 1) / 2)) for side in (1, -1)]
        if ahead[0] not in cells:
            turned = (way + 1) % 4
        elif ahead[1] in cells:
            turned = (way + 3) % 4
        else:
            turned = way
        if turned != way:
            ring.append(at)
        way = turned
        if at == (x, y):
            return ring


@pytest.mark.parametrize("tile", [3, 64])
def test_outlines_equal_a_walk_with_holes_and_touching_corners(spark, tile):
    rng = np.random.default_rng(31)
    rows = [(img, int(y), int(x), 1) for img in range(6) for y, x in zip(*np.nonzero(rng.random((9, 9)) < 0.62))]
    rows += [(9, 0, 0, 7), (9, 0, 300, 8)] + [(9, 5, x, 5) for x in range(500)]  # a dot, a dot, a long ring
    snake = [(y, x) for y in range(0, 15, 2) for x in range(20)] + [(y, 19 if y % 4 == 1 else 0) for y in range(1, 14, 2)]
    rows += [(10, y, x, 3) for y, x in snake]
    df = spark.createDataFrame(rows, "img long, y int, x int, inst_id int")
    got = {(r.img, r.cell_ids): r.polygon for r in mask_rings(df, tile=tile).collect()}
    sets = {}
    for img, y, x, inst in rows:
        sets.setdefault((img, inst), set()).add((y, x))
    assert got.keys() == sets.keys()
    for key, cells in sets.items():
        part, todo = set(), [min(cells)]
        while todo:
            y, x = todo.pop()
            if (y, x) in cells and (y, x) not in part:
                part.add((y, x))
                todo += [(y + 1, x), (y - 1, x), (y, x + 1), (y, x - 1)]
        want = _walked(part)
        assert got[key] == "POLYGON ((" + ", ".join(f"{x} {y}" for x, y in want) + "))", key
    assert mask_rings(df.limit(0), tile=tile).count() == 0


def test_merged_hulls_do_not_depend_on_the_band(spark):
    rng = np.random.default_rng(32)
    rows = [(0, int(y), int(x), i) for i in range(4) for y, x in rng.integers(0, 60, (30, 2))]
    df = spark.createDataFrame(rows, "img long, y int, x int, inst_id int").distinct()
    found = [
        {r.inst_id: (r.area, r.area_convex) for r in convex_areas(df, band).collect()} for band in (1, 7, 1000)
    ]
    assert found[0] == found[1] == found[2] and len(found[0]) == 4
    assert all(60 * 60 > convex > 1500 > area for area, convex in found[0].values())


def test_label_contraction_on_a_long_chain(spark):
    rng = np.random.default_rng(8)
    order = rng.permutation(300)
    edges = [(int(order[i]), int(order[i + 1])) for i in range(299) if i != 149]
    df = spark.createDataFrame(edges, "a long, b long")
    roots = {r.id: r.root for r in contract_labels(df).collect()}
    first, second = set(order[:150].tolist()), set(order[150:].tolist())
    assert len(roots) == 300
    assert {roots[i] for i in first} == {min(first)} and {roots[i] for i in second} == {min(second)}


def test_convex_and_filled_areas(spark):
    ring = [(0, y, x, 1) for y in range(5) for x in range(5) if not (1 <= y <= 3 and 1 <= x <= 3)]
    ell = [(0, y, x, 2) for y in range(10, 14) for x in range(4) if y == 13 or x == 0]
    dot = [(0, 20, 20, 3)]
    df = spark.createDataFrame(ring + ell + dot, "img long, y int, x int, inst_id int")
    got = {r.inst_id: (r.area, r.area_convex, r.area_filled) for r in hull_features(df, tile=3).collect()}
    # The L of 4 x 4: its hull holds the ten pixels on and below the diagonal.
    assert got == {1: (16, 25, 25), 2: (7, 10, 7), 3: (1, 1, 1)}


def test_slides_with_equal_cell_ids_stay_apart(spark):
    """Two overlapping slides give what each gives alone."""
    rng = np.random.default_rng(11)
    cells = spark.createDataFrame(
        [(s, i, *map(float, rng.integers(-6, 22, 2)), "ab"[i % 2]) for s in ("s1", "s2") for i in range(60)],
        "slide string, cell_ids int, cell_x double, cell_y double, cell_type string",
    )
    spots = spark.createDataFrame(
        [("s1", "A", 4, 4), ("s1", "B", 12, 12), ("s2", "A", 5, 10)],
        "slide string, barcode string, pxl_row_in_fullres int, pxl_col_in_fullres int",
    )
    rings = _regions(spark, p=SQUARE).withColumn("slide", F.lit("s1")).unionByName(
        _regions(spark, p=ELL).withColumn("slide", F.lit("s2"))
    )

    def both(run, columns):
        got = sorted(run(cells, spots, rings, ["slide"]).select("slide", *columns).collect())
        want = []
        for s in ("s1", "s2"):
            parts = [t.filter(F.col("slide") == s) for t in (cells, spots, rings)]
            parts = [parts[0].drop("slide"), parts[1].drop("slide"), parts[2].drop("slide")]
            want += [(s, *r) for r in run(*parts, []).select(*columns).collect()]
        assert [tuple(r) for r in got] == sorted(want)
        return got

    def placed(c, s, r, by):
        return spatial.assign_cells_to_spots(c, s, 5.0, by=by).fillna("-", ["barcode"])

    assert len(both(placed, ["cell_ids", "barcode"])) == 120
    both(lambda c, s, r, by: spatial.contained_cells(placed(c, s, r, by), s, by), ["barcode", "num_contained_cells"])
    both(lambda c, s, r, by: spatial.region_members(c, r, "cell_ids", "cell_x", "cell_y", 4.0, by), ["region_name", "cell_ids"])

    def tested(c, s, r, by):
        levels = spatial.infiltration_levels(c, r, 2, 3, unit=4.0, by=by)
        return spatial.infiltration_test(spatial.infiltration_table(levels, 65.0, 2, by), by=by)

    both(tested, ["region_name", "cell_type", "x1", "n2", "p", "significant"])

    def met(c, s, r, by):
        counts = cooccurrence.pair_counts(c, None, [0, 2, 5, 12], tile=4.0, block_rows=8, by=by)
        return cooccurrence.co_occurrence(counts, [0, 2, 5, 12], by)

    both(met, ["distance", "type_a", "type_b", "n", "ratio"])


def test_unlisted_type_is_refused(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0, "a"), (2, 1.0, 0.0, "z")], "cell_ids int, cell_x double, cell_y double, cell_type string")
    with pytest.raises(Exception, match="not listed: z"):
        cooccurrence.pair_counts(df, ["a"], [0, 3]).collect()


def test_infiltration_p_values(spark):
    table = spark.createDataFrame(
        [("k", "r", level, t, n) for level, a, b in [(2, 10, 40), (0, 30, 20), (-2, 30, 30)] for t, n in (("a", a), ("b", b))],
        "region_class string, region_name string, level int, cell_type string, abundance long",
    )
    x1, n1, x2, n2 = 60, 110, 10, 50
    pool = (x1 + x2) / (n1 + n2)
    z = (x1 / n1 - x2 / n2) / math.sqrt(pool * (1 - pool) * (1 / n1 + 1 / n2))
    for side, p in (("two-sided", math.erfc(z / 2**0.5)), ("larger", 0.5 * math.erfc(z / 2**0.5)), ("smaller", 0.5 * math.erfc(-z / 2**0.5))):
        row = spatial.infiltration_test(table, buffer=False, alternative=side).filter("cell_type = 'a'").first()
        assert row.z == pytest.approx(z) and row.p == pytest.approx(p) and row.significant == (p < 0.05)
    alone = table.filter("level = 2")
    assert [(r.z, r.p, r.significant) for r in spatial.infiltration_test(alone).collect()] == [(0.0, 1.0, False)] * 2


def _turned(points, angle):
    c, s = math.cos(angle), math.sin(angle)
    return np.unique(points @ np.array([[c, s], [-s, c]]), axis=0)


def test_triangulation_of_turned_grids_and_circles():
    """n points, h of them on the hull: 2n - 2 - h triangles whatever the rounding."""
    side = np.arange(12.0)
    grid = np.stack(np.meshgrid(side, side), -1).reshape(-1, 2) * 17
    layouts = [grid, *(_turned(grid, a) for a in (0.1, 0.3, 0.7, 1.2))]
    for k in (8, 40, 120):
        t = 2 * np.pi * np.arange(k) / k
        layouts.append(np.unique(np.stack([np.cos(t), np.sin(t)], 1) * 100, axis=0))
    for xy in layouts:
        tri = triangulate(xy)
        solid = tri[tri[:, 2] >= 0]
        assert len(solid) == 2 * len(xy) - 2 - (len(tri) - len(solid))
        assert len(np.unique(np.sort(solid, axis=1), axis=0)) == len(solid)


def test_windows_agree_on_a_turned_slide(spark):
    rng = np.random.default_rng(12)
    side = np.arange(20.0)
    # A lattice with small shifts: neighbours are unique, rounding matters all the same.
    grid = np.stack(np.meshgrid(side, side), -1).reshape(-1, 2) * 16 + rng.integers(0, 4, (400, 2)) / 8
    xy = _turned(grid, 0.3)
    cells = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(xy)], "id long, x double, y double")
    got = {(r.src, r.dst) for r in delaunay_edges(cells, tile_cap=60, last_cap=90).collect()}
    tri = triangulate(xy)
    solid = tri[tri[:, 2] >= 0]
    kept = [*solid[~flat(xy, solid)], *tri[tri[:, 2] < 0][:, :2]]
    want = {(int(a), int(b)) for t in kept for a in t for b in t if a != b}
    assert got == want


def test_rows_of_a_large_polygon_answer_like_its_whole_ring(spark):
    """A comb of 4,000 corners, a star, a triangle and a flat ring, points on corners and edges among them."""
    teeth = [(float(i), 40.0 if i % 2 else 3.0) for i in range(3998)]
    comb = [(0.0, 0.0), *teeth, (3997.0, 0.0)]
    star = [(100 + (30 if k % 2 else 12) * math.cos(k * 0.3), 20 + (30 if k % 2 else 12) * math.sin(k * 0.3)) for k in range(20)]
    rings = {"comb": comb, "star": star, "triangle": [(0.0, 0.0), (50.0, 0.0), (0.0, 50.0)], "flat": [(0.0, 7.0), (9.0, 7.0), (4.0, 7.0)], None: [(5.0, 5.0), (25.0, 5.0), (25.0, 25.0), (5.0, 25.0)]}
    regions = spark.createDataFrame(
        [("class", name, [{"x": x, "y": y} for x, y in ring]) for name, ring in rings.items()],
        "region_class string, region_name string, ring array<struct<x: double, y: double>>",
    )
    rng = np.random.default_rng(2)
    points = [(float(x), float(y)) for x, y in zip(rng.uniform(0, 200, 600), rng.uniform(-2, 45, 600))]
    points += [(float(x), float(y)) for x in range(0, 60, 5) for y in range(0, 50, 5)] + [comb[5], comb[9], star[3]]
    df = spark.createDataFrame([(i, x, y, "kept") for i, (x, y) in enumerate(points)], "id int, px double, py double, more string")
    got = {(r["region_name"], r["id"]) for r in spatial.region_members(df, regions, "id", "px", "py").collect()}

    def inside(ring, x, y):
        odd = False
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if (x2 - x1) * (y - y1) == (y2 - y1) * (x - x1) and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
                return False
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd = not odd
        return odd

    assert got == {(name, i) for name, ring in rings.items() for i, (x, y) in enumerate(points) if inside(ring, x, y)}
    boxes, rows = spatial.region_rows(regions)
    held = {r["name"]: r["n"] for r in rows.groupBy("_region.region_name").agg(F.sum(F.size("_edges")).alias("n")).withColumnRenamed("region_name", "name").collect()}
    assert held["comb"] <= 2 * 4000 and held["star"] <= 2 * 20 + 20


def test_parts_of_instances_at_one_place(spark):
    rows = [(img, y, x, inst) for img in "ab" for inst in (1, 2) for y in range(6) for x in (0, 1, 3) if x != 3 or inst == 2]
    pixels = spark.createDataFrame(rows + rows[:1], "img string, y int, x int, inst_id int")
    parts = mask_components(pixels, tile=4).groupBy("img", "inst_id", "component").count().collect()
    both = {(img, inst, at, n) for img in "ab" for inst, at, n in ((1, 0, 12), (2, 0, 12), (2, 3, 6))}
    assert {tuple(r) for r in parts} == both - {("a", 1, 0, 12)} | {("a", 1, 0, 13)}


def test_groups_stay_whole_over_batches(monkeypatch):
    monkeypatch.setattr(components, "AT_ONCE", 3)
    keys = [None, None, "a", "a", "a", "a", "b", "c", "c"]
    batches = [pa.RecordBatch.from_pydict({"k": pa.array(keys[i : i + 2], pa.string())}) for i in range(0, 9, 2)]
    groups = []
    for table, starts in components.whole_groups(iter(batches), ["k"]):
        stops = [*starts[1:], table.num_rows]
        groups += [table["k"].to_pylist()[i:j] for i, j in zip(starts, stops, strict=True)]
    assert groups == [[None, None], ["a"] * 4, ["b"], ["c", "c"]]
