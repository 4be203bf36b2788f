import json

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo

from spotloom.operators.components import outline_corners
from spotloom.operators.masks import instance_info, moment_features, pattern_features
from spotloom.plans.stages import Settings, run
from spotloom.sinks import report, writers
from spotloom.sources import arrays, readers
from spotloom.sources.json_records import json_records
from spotloom.streaming import quality as stream


def test_text_readers(spark, tmp_path):
    (tmp_path / "pos.csv").write_text("x,y,z,q,r,s\nb1,1,0,0,10,20\nb2,0,0,2,10,40\n")
    assert [r.barcode for r in readers.positions(spark, str(tmp_path / "pos.csv")).collect()] == ["b1"]
    (tmp_path / "params.csv").write_text("name,value\ntissue_type,kidney\nspecies,mouse\n")
    assert readers.parameters(spark, str(tmp_path / "params.csv")).first().params["species"] == "mouse"
    (tmp_path / "scale.json").write_text(json.dumps({"spot_diameter_fullres": 89.4, "other": 1}))
    assert readers.scale_factors(spark, str(tmp_path / "scale.json")).first()[0] == 89.4
    assert readers.optional_csv(spark, str(tmp_path / "none.csv")) is None
    (tmp_path / "tsne.csv").write_text("Barcode,TSNE-1,TSNE-2\nb1,0.5,1.5\n")
    assert readers.optional_csv(spark, str(tmp_path / "tsne.csv")).columns == ["barcode", "TSNE-1", "TSNE-2"]
    for k in (3, 5):
        (tmp_path / f"kmeans_{k}.csv").write_text(f"Barcode,Cluster\nb1,{k}\n")
    wide = readers.wide_clusters(readers.cluster_files(spark, str(tmp_path / "*kmeans*")), ["kmeans_3", "kmeans_5"])
    assert wide.first().asDict() == {"barcode": "b1", "kmeans_3": "3 (Gene cluster)", "kmeans_5": "5 (Gene cluster)"}


def _feature(name, rings):
    return {"properties": {"name": name, "classification": {"name": "k"}}, "geometry": {"type": "Polygon", "coordinates": rings}}


@pytest.mark.parametrize("wrapped", [True, False])
def test_annotations(spark, tmp_path, wrapped):
    ring = [[0, 0], [4, 0], [4, 4], [0, 0]]
    features = [_feature("a", [[[9, 9], [8, 8], [7, 9]]]), _feature("a", [ring]), _feature("holed", [ring, ring])]
    path = tmp_path / "a.geojson"
    path.write_text(json.dumps({"features": features} if wrapped else features))
    rows = readers.annotations(spark, str(path)).collect()
    assert [(r.region_name, len(r.ring)) for r in rows] == [("a", 4)]


def test_nuclei_json(spark, tmp_path):
    (tmp_path / "n.json").write_text(json.dumps({"mag": 40, "nuc": {"1": {"bbox": [[0, 0], [2, 2]], "centroid": [1.5, 2.5], "contour": [[0, 0]], "type_prob": 0.9, "type": 1}, "2": {"centroid": [3, 4], "type": 7}}}))
    (tmp_path / "t.json").write_text(json.dumps({"1": ["epithelial", [255, 0, 16]]}))
    types = readers.type_info(spark, str(tmp_path / "t.json"))
    got = {r.cell_ids: (r.cell_x, r.cell_type, r.color) for r in readers.nuclei(spark, str(tmp_path / "n.json"), types).collect()}
    assert got == {"1": (1.5, "epithelial", "#ff0010"), "2": (3.0, None, None)}


def test_array_sources(spark, tmp_path):
    mask = np.zeros((70, 9), dtype=np.int32)
    mask[3, 4], mask[66, 8] = 5, 6
    np.save(tmp_path / "mask.npy", mask)
    got = {tuple(r) for r in arrays.read_mask(spark, str(tmp_path / "mask.npy"), rows_per_task=16).collect()}
    assert got == {(3, 4, 5), (66, 8, 6)}
    image = np.arange(24, dtype=np.uint8).reshape(4, 3, 2)
    np.save(tmp_path / "image.npy", image)
    arrays.register(spark)
    pixels = spark.read.format("raster_image").option("rows_per_task", 2).load(str(tmp_path / "image.npy"))
    assert pixels.agg(F.count("*"), F.sum("value")).first() == (24, float(image.sum()))
    folder = tmp_path / "counts"
    folder.mkdir()
    parts = {
        "indptr": np.array([0, 2, 2, 3]), "indices": np.array([0, 2, 1]), "data": np.array([4, 1, 7]),
        "barcodes": np.array(["b1", "b2", "b3"]), "gene_ids": np.array(["g1", "g2", "g3"]),
        "gene_names": np.array(["A", "B", "DEPRECATED_C"]),
    }
    for name, value in parts.items():
        np.save(folder / f"{name}.npy", value)
    got = {(r.barcode, r.gene, r["count"]) for r in arrays.read_counts(spark, str(folder), barcodes_per_task=1).collect()}
    assert got == {("b1", "g1", 4), ("b3", "g2", 7)}


def test_writers_and_report(spark, tmp_path):
    cells = spark.createDataFrame([(1.0, 2.0, "1")], "cell_x double, cell_y double, type_id string")
    types = spark.createDataFrame([("1", "t", [1, 2, 3])], "type_id string, cell_type string, rgb array<int>")
    writers.save_annotation_tsv(cells, types, str(tmp_path / "tsv"))
    text = next((tmp_path / "tsv").glob("*.csv")).read_text().splitlines()
    assert text == ["x\ty\tclass\tname\tcolor", "1.0\t2.0\t\tt\t66051"]
    writers.save_table(cells, str(tmp_path / "t"), ["type_id"])
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1
    writers.save_run_config({"a": 1}, str(tmp_path / "run.json"))
    assert json.loads((tmp_path / "run.json").read_text()) == {"a": 1}
    menu = writers.viewer_config("x", ["layers/cells.png"], {"qc": ["qc_a"], "genes": []}, ["t"])
    assert [m["title"] for m in menu["markerFiles"]] == ["qc", "cells"]
    report.write_report(str(tmp_path / "r.html"), "Sample <1>", {"cells": cells}, {"cells": "all"})
    page = (tmp_path / "r.html").read_text()
    assert "Sample &lt;1&gt;" in page and "<td>1.0</td>" in page
    with pytest.raises(ValueError):
        readers.allowed("method", "x", ["a"])


def test_stream_equals_batch(spark, tmp_path):
    expr = spark.createDataFrame([(f"b{i % 3}", f"g{i}", i % 4) for i in range(24)], "barcode string, gene string, count long")
    for k in range(3):
        expr.filter(F.expr(f"cast(substr(gene, 2) as int) % 3 = {k}")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    counts = stream.arriving_counts(spark, str(tmp_path / "in"), 1)
    stream.start_spot_metrics(counts, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    got = {tuple(r) for r in stream.current_spot_metrics(spark, str(tmp_path / "out")).select("barcode", "qc_nGenes", "qc_nCounts").collect()}
    batch = expr.filter("count > 0").groupBy("barcode").agg(F.count("*"), F.sum("count"))
    assert got == {tuple(r) for r in batch.collect()}


def test_shape_features_of_a_square(spark):
    rows = [(0, y, x, 1, 1.0) for y in range(4) for x in range(4)]
    px = spark.createDataFrame(rows, "img long, y int, x int, inst_id int, intensity double")
    shape = moment_features(px).first()
    assert shape.area == 16 and shape.extent == 1 and shape.eccentricity == 0
    assert shape.axis_major_length == pytest.approx(4 * np.sqrt(1.25))
    pattern = pattern_features(px).first()
    assert pattern.euler_number == 1 and pattern.perimeter == pytest.approx(12)
    ring = px.filter("not (y in (1, 2) and x in (1, 2))")
    assert pattern_features(ring).first().euler_number == 0


def test_all_stages_on_a_small_sample(spark, tmp_path):
    rng = np.random.default_rng(0)
    spots, cells, expr, abundance, features = [], [], [], [], []
    cell = 0
    for r in range(4):
        for c in range(r % 2, 12, 2):
            name = f"s{r}-{c}"
            spots.append((name, 1, r, c, 87 * r, 50 * c, c // 2 % 2))
            for g in range(12):
                expr.append((name, f"G{g}", int(rng.poisson(3 + g)) + 1))
            for t, a in zip(("t cell", "b cell"), rng.random(2) + 0.2):
                abundance.append((name, t, float(a)))
            for _ in range(6):
                dx, dy = rng.uniform(-20, 20, 2)
                cells.append((cell, float(50 * c + dx), float(87 * r + dy), float(rng.uniform(20, 80))))
                features.append((cell, [float(v) for v in rng.normal(0, 1, 12)]))
                cell += 1
    tables = {
        "spots": spark.createDataFrame(spots, "barcode string, in_tissue int, array_row int, array_col int, pxl_row_in_fullres int, pxl_col_in_fullres int, cluster int"),
        "cells": spark.createDataFrame(cells, "cell_ids long, cell_x double, cell_y double, area double"),
        "expr": spark.createDataFrame(expr, "barcode string, gene string, count long"),
        "genes": spark.createDataFrame([(f"G{g}", f"G{g}") for g in range(12)], "gene string, gene_name string"),
        "abundance": spark.createDataFrame(abundance, "barcode string, cell_type string, abundance double"),
        "features": spark.createDataFrame(features, "cell_ids long, features array<double>"),
        "regions": spark.createDataFrame(
            [("k", "r", [{"x": -60.5, "y": -60.5}, {"x": 260.5, "y": -60.5}, {"x": 260.5, "y": 230.5}, {"x": -60.5, "y": 230.5}])],
            "region_class string, region_name string, ring array<struct<x double, y double>>",
        ),
    }
    for method in ("naive", "global"):
        settings = Settings(assign_method=method, cluster_method="kmeans", n_top_expressed=8, intervals=12,
                            cell_types=("t-cell", "b-cell"))
        settings.figures = tuple(f for f in settings.figures if f != "variable_genes")
        state = run(tables, settings, str(tmp_path / method))
        assert state["cells"].filter("barcode is not null").count() > 100
        assert state["spot_clusters"].filter("confidence_score is null").count() == 0
        assert state["merged_cells"].count() == cell
        assert state["merged_expr"].select("gene").distinct().count() == 8
        assert state["cell_counts"].count() == 2
        assert state["cell_cooccur"].count() > 0
        assert state["infilt_test"].count() == 2
        assert state["diff_exp_clusters"].count() == 8 * 4
        assert state["morans_gene"].count() == 8


@pytest.fixture
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {n: spark.conf.get(n) for n in names}

    def use(size):
        for n in names:
            spark.conf.set(n, str(size))

    yield use
    for n, value in old.items():
        spark.conf.set(n, value)


ODD = ['a "quoted} name', "brace { and ] in text", "back\\slash\\", "]}{[", "", "nuc", "\u00e9\u4e2d"]


@pytest.mark.parametrize("size, indent", [(150, None), (601, 1), (1 << 20, None)])
def test_json_records_do_not_depend_on_the_splits(spark, tmp_path, small_splits, size, indent):
    features = [
        {"type": "Feature", "properties": {"name": ODD[i % 7], "deep": [{"x": {"y": [i, {}]}}]}, "i": i} for i in range(25)
    ]
    files = {
        "wrapped": {"type": "x", "crs": {"properties": {"features": [{"no": 1}]}, "list": [{"no": 2}]}, "features": features, "z": [{"no": 3}]},
        "bare": features,
        "keyed": {"mag": None, "nuc": {f"n{i}": f for i, f in enumerate(features)}, "features": {}},
    }
    for name, value in files.items():
        (tmp_path / name).write_text(json.dumps(value, indent=indent, ensure_ascii=False))
    small_splits(size)
    for name in files:
        found = json_records(spark, str(tmp_path / name), "nuc" if name == "keyed" else "features")
        rows = found.orderBy("file", "block", "k").collect()
        assert [json.loads(r.value) for r in rows] == features, name
        assert [r.key for r in rows] == [f"n{i}" if name == "keyed" else None for i in range(25)]
        assert size > 1000 or len({r.block for r in rows}) > 1
    (tmp_path / "none").write_text('{"features": []}')
    assert json_records(spark, str(tmp_path / "none"), "features").count() == 0


def test_absent_annotations_are_no_polygons(spark, tmp_path):
    assert readers.annotations(spark, str(tmp_path / "nothing.json")).count() == 0


def test_filters_reach_the_count_matrix(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(5)
    dense = rng.integers(0, 4, (40, 30))
    owner, index = np.nonzero(dense)
    parts = {
        "indptr": np.concatenate([[0], np.cumsum((dense > 0).sum(axis=1))]), "indices": index, "data": dense[owner, index],
        "barcodes": np.array([f"b{i}" for i in range(40)]), "gene_ids": np.array([f"g{i}" for i in range(30)]),
        "gene_names": np.array([f"G{i // 2}" for i in range(30)]),
    }
    for name, value in parts.items():
        np.save(tmp_path / f"{name}.npy", value)
    counts = arrays.read_counts(spark, str(tmp_path), barcodes_per_task=16)
    every = {tuple(r) for r in counts.collect()}
    assert len(every) == len(index)
    for text, test in {
        "barcode = 'b7'": lambda r: r[0] == "b7",
        "barcode IN ('b3', 'b4', 'b39', 'none')": lambda r: r[0] in ("b3", "b4", "b39"),
        "gene IN ('g1', 'g20') AND count > 1": lambda r: r[1] in ("g1", "g20") and r[3] > 1,
        "gene_name = 'G3' AND barcode = 'b0' AND gene <> 'g6'": lambda r: r[2] == "G3" and r[0] == "b0" and r[1] != "g6",
        "gene = 'g1' AND gene = 'g2'": lambda r: False,
        "barcode = 'b1' OR count = 3": lambda r: r[0] == "b1" or r[3] == 3,
    }.items():
        assert {tuple(r) for r in counts.filter(text).collect()} == {r for r in every if test(r)}, text
    plan = counts.filter("barcode = 'b7'")._jdf.queryExecution().executedPlan().toString()
    assert "isnotnull(barcode" in plan and "b7" not in plan  # the reader has taken the comparison

    def read(*filters):
        reader, seen, part = arrays._CountReader({"path": str(tmp_path), "barcodes_per_task": 16}), [], arrays._CountReader._part
        list(reader.pushFilters(list(filters)))

        def counted(self, name, window=slice(None)):
            got = part(self, name, window)
            seen.append(len(got) if name in ("indices", "data") else 0)
            return got

        monkeypatch.setattr(arrays._CountReader, "_part", counted)
        rows = sum(b.num_rows for p in reader.partitions() for b in reader.read(p))
        monkeypatch.setattr(arrays._CountReader, "_part", part)
        return rows, sum(seen)

    rows, entries = read(EqualTo(("barcode",), "b7"))
    assert rows == (dense[7] > 0).sum() and entries == 2 * rows and 10 * entries < read()[1]
    assert read(EqualTo(("gene",), "none")) == (0, 0)


def test_instance_documents_are_read_back_and_leave_no_half_file(spark, tmp_path):
    rows = [(img, y, x, i, 1) for img in range(2) for i in range(1, 8) for y in range(i) for x in range(10 * i, 10 * i + 3)]
    px = spark.createDataFrame(rows, "img long, y int, x int, inst_id int, pixel_type int")
    corners = outline_corners(px.select("img", "y", "x", "inst_id"), tile=4)
    info = instance_info(px)
    writers.save_instance_documents(info, corners, str(tmp_path / "out"), 20.0, per_line=3)
    records = json_records(spark, str(tmp_path / "out" / "*"), "nuc").collect()
    assert sorted(r.key for r in records) == sorted([str(i) for i in range(1, 8)] * 2)
    for r in records:
        i, body = int(r.key), json.loads(r.value)
        assert body["bbox"] == [[0, 10 * i], [i, 10 * i + 3]] and body["type"] == 1
        assert body["contour"] == [[10 * i, 0], [10 * i + 3, 0], [10 * i + 3, i], [10 * i, i]]
    lines = [json.loads(t) for f in (tmp_path / "out" / "img=0").glob("*.txt") for t in f.read_text().splitlines()]
    assert len(lines) == 3 and all(line["mag"] == 20.0 for line in lines)
    broken = info.withColumn("type", F.when(F.col("inst_id") == 7, F.raise_error("stop").cast("int")).otherwise(F.col("type")))
    with pytest.raises(Exception, match="stop"):
        writers.save_instance_documents(broken, corners, str(tmp_path / "half"), 20.0)
    assert not list((tmp_path / "half").glob("img=*")) and not (tmp_path / "half" / "_SUCCESS").exists()
