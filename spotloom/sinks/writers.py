"""Table and export writers."""

from __future__ import annotations

import json
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def save_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet") -> None:
    """One result table; partitioned so that a sample can be read or replaced alone."""
    writer = df.write.mode("overwrite").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)


def packed_colour(rgb: Column) -> Column:
    """r * 65536 + g * 256 + b."""
    return F.shiftleft(rgb[0], 16) + F.shiftleft(rgb[1], 8) + rgb[2]


def annotation_rows(cells: DataFrame, types: DataFrame) -> DataFrame:
    """x, y, class, name and packed colour of every cell, for slide viewers."""
    named = types.select("type_id", F.col("cell_type").alias("name"), packed_colour(F.col("rgb")).alias("color"))
    return cells.join(named, "type_id").select(
        F.col("cell_x").alias("x"), F.col("cell_y").alias("y"), F.lit("").alias("class"), "name", "color"
    )


def save_annotation_tsv(cells: DataFrame, types: DataFrame, path: str) -> None:
    rows = annotation_rows(cells, types)
    rows.write.mode("overwrite").option("sep", "\t").option("header", True).option("emptyValue", "").csv(path)


def instance_json(info: DataFrame) -> DataFrame:
    """One JSON text per instance: {"id": {bbox, centroid, type_prob, type}}."""
    body = F.struct(
        F.array(F.array("rmin", "cmin"), F.array("rmax", "cmax")).alias("bbox"),
        F.array("centroid_x", "centroid_y").alias("centroid"),
        "type_prob",
        "type",
    )
    return info.select("img", F.to_json(F.create_map(F.col("inst_id").cast("string"), body)).alias("json"))


def instance_documents(
    info: DataFrame, corners: DataFrame, mag: float | None = None, per_line: int = 1000
) -> DataFrame:
    """(img, value): whole JSON documents {"mag": ..., "nuc": {"id": {...}}} of bounded size.

    An instance has bbox, centroid, contour, type_prob and type; ``corners`` is the table
    of ``outline_corners``, and an instance without an outline has a null contour. Ids of
    one document share ``id div per_line``, so no image is gathered in one row.
    """
    points = F.sort_array(F.collect_list(F.struct((-F.col("left")).alias("k"), F.array("x", "y").alias("p"))))["p"]
    drawn = corners.groupBy("img", F.col("cell_ids").alias("inst_id")).agg(points.alias("_c"))
    contour = F.concat(F.slice("_c", -1, 1), F.slice("_c", 1, F.size("_c") - 1))
    body = F.struct(
        F.array(F.array("rmin", "cmin"), F.array("rmax", "cmax")).alias("bbox"),
        F.array("centroid_x", "centroid_y").alias("centroid"),
        contour.alias("contour"),
        "type_prob",
        "type",
    )
    entry = F.struct(F.col("inst_id").cast("string").alias("id"), body.alias("body"))
    nuc = F.map_from_entries(F.sort_array(F.collect_list(entry)))
    grouped = info.join(drawn, ["img", "inst_id"], "left").groupBy("img", F.floor(F.col("inst_id") / per_line).alias("_part"))
    text = F.to_json(F.struct(F.lit(mag).cast("double").alias("mag"), "nuc"), {"ignoreNullFields": "false"})
    return grouped.agg(nuc.alias("nuc")).select("img", text.alias("value"))


def save_instance_documents(
    info: DataFrame, corners: DataFrame, path: str, mag: float | None = None, per_line: int = 1000
) -> None:
    """``instance_documents`` as lines of text, in a folder for each image.

    Spark's committer publishes the files of tasks that ended, so a lost or failed task
    leaves no half file; ``readers.nuclei`` reads the folders.
    """
    instance_documents(info, corners, mag, per_line).write.mode("overwrite").partitionBy("img").text(path)


def save_run_config(config: dict, path: str) -> None:
    Path(path).write_text(json.dumps(config, indent=2, sort_keys=True, default=str))


def viewer_config(
    name: str, layers: Sequence[str], spot_columns: dict[str, Sequence[str]], cell_columns: Sequence[str]
) -> dict:
    """Layers and marker menus of a slide viewer, from column lists alone.

    ``spot_columns`` maps a menu (qc, clusters, genes, ...) to its columns.
    """
    def marker(title: str, csv: str, x: str, y: str, key: str, options: Sequence[str]) -> dict:
        return {
            "title": title,
            "path": csv,
            "expectedHeader": {"X": x, "Y": y, "gb_col": key},
            "dropdownOptions": [{"optionName": o, "value": o} for o in options],
        }

    menus = [
        marker(title, "merged_spots.csv", "pxl_col_in_fullres", "pxl_row_in_fullres", title, columns)
        for title, columns in spot_columns.items()
        if columns
    ]
    if cell_columns:
        menus.append(marker("cells", "merged_cells.csv", "cell_x", "cell_y", "cell_type", cell_columns))
    return {
        "filename": name,
        "layers": [{"name": Path(p).stem, "tileSource": p} for p in layers],
        "markerFiles": menus,
    }
