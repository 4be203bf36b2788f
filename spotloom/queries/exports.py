"""Exports, JSON access and spatially variable genes."""

from pyspark.sql import functions as F

from .. import domain as d
from ..operators import masks as mk
from ..operators import variability as va
from ..registry import query
from ..sinks import writers
from ..sources import readers


def _types(spark, sf):
    """Type names and colours, one per nation key."""
    nation = d.table(spark, sf, "nation")
    key = F.col("n_nationkey")
    return nation.select(
        key.cast("string").alias("type_id"),
        F.col("n_name").alias("cell_type"),
        F.array(key * 10, key + 100, 255 - key).cast("array<int>").alias("rgb"),
    )


def _typed_cells(spark, sf):
    k = F.get_json_object("props", "$.k").cast("int")
    cells = d.table(spark, sf, "events").select("event_id", k.alias("k"))
    return d.cells(spark, sf).join(cells, F.col("cell_ids") == F.col("event_id")).select(
        "cell_ids", "cell_x", "cell_y", F.expr("cast(k div 3 as string)").alias("type_id")
    )


_TYPED = """typed AS (
    SELECT cell_ids, cell_x, cell_y, (json_extract_string(props, '$.k')::int // 3)::varchar AS type_id
    FROM cells JOIN events ON cell_ids = event_id)"""


@query(
    "export_named_cells",
    d.sql(
        "cells", extra=_TYPED,
        body="""SELECT type_id, cell_ids, cell_x, cell_y, n_name AS cell_type,
    printf('#%02x%02x%02x', n_nationkey * 10, n_nationkey + 100, 255 - n_nationkey) AS color
FROM typed LEFT JOIN nation ON n_nationkey::varchar = type_id""",
    ),
)
def export_named_cells(spark, sf):
    return readers.name_types(_typed_cells(spark, sf), _types(spark, sf))


@query(
    "export_annotation_rows",
    d.sql(
        "cells", extra=_TYPED,
        body="""SELECT cell_x AS x, cell_y AS y, '' AS class, n_name AS name,
    (n_nationkey * 10 * 65536 + (n_nationkey + 100) * 256 + 255 - n_nationkey)::int AS color
FROM typed JOIN nation ON n_nationkey::varchar = type_id""",
    ),
)
def export_annotation_rows(spark, sf):
    return writers.annotation_rows(_typed_cells(spark, sf), _types(spark, sf))


@query(
    "export_colour_classes",
    d.sql(
        body="""SELECT p_partkey, p_size, coalesce(n_regionkey, -1)::int AS class_id FROM part
LEFT JOIN nation ON n_nationkey = p_size""",
    ),
)
def export_colour_classes(spark, sf):
    rgb = F.array(F.col("p_size"), F.lit(0), F.lit(0))
    pixels = d.table(spark, sf, "part").select("p_partkey", "p_size", rgb.alias("rgb"))
    classes = d.table(spark, sf, "nation").select(
        F.array(F.col("n_nationkey"), F.lit(0), F.lit(0)).alias("rgb"), F.col("n_regionkey").alias("class_id")
    )
    return readers.colour_classes(pixels, classes).drop("rgb")


@query(
    "export_instance_json",
    d.sql(
        "masks",
        body="""SELECT img, inst_id, min(y) AS rmin, max(x) + 1 AS cmax, count(*) AS size FROM (
    SELECT img, y, x, true_id AS inst_id FROM masks WHERE true_id > 0) GROUP BY 1, 2""",
    ),
)
def export_instance_json(spark, sf):
    """Instances written as JSON text and read back through the declared schema."""
    px = mk.foreground(d.masks(spark, sf), "true_id")
    info = mk.instance_info(px)
    body = "map<string, struct<bbox: array<array<int>>>>"
    texts = writers.instance_json(info)
    back = texts.select("img", F.explode(F.from_json("json", body)).alias("k", "v")).select(
        "img",
        F.col("k").cast("int").alias("inst_id"),
        F.col("v.bbox")[0][0].alias("rmin"),
        F.col("v.bbox")[1][1].alias("cmax"),
    )
    return back.join(info.select("img", "inst_id", "size"), ["img", "inst_id"])


def _capture_areas(spark, sf):
    """Capture areas of 480 lattice positions, numbered along the slide."""
    return d.spots(spark, sf).filter("in_tissue = 1").select(
        F.expr("barcode div 480").alias("exp_id"), "barcode",
        F.col("pxl_col_in_fullres").cast("double").alias("x"),
        F.col("pxl_row_in_fullres").cast("double").alias("y"),
    )


@query("variable_genes")
def variable_genes(spark, sf):
    return va.spatial_variability(d.expr(spark, sf), _capture_areas(spark, sf))


@query("variable_genes_top")
def variable_genes_top(spark, sf):
    return va.top_variable(variable_genes(spark, sf), 100, limit=1.0, min_count=200)
