"""File readers that return lazy DataFrames with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from .. import schemas
from .json_records import json_records


def positions(spark: SparkSession, path: str, in_tissue_only: bool = True) -> DataFrame:
    """Six named columns; the file's own header line is discarded."""
    df = spark.read.schema(schemas.POSITIONS).option("header", True).option("enforceSchema", True).csv(path)
    return df.filter("in_tissue = 1") if in_tissue_only else df


def scale_factors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("spot_diameter_fullres double").option("multiLine", True).json(path)


def parameters(spark: SparkSession, path: str) -> DataFrame:
    """One row with a map of all parameters; the first line is a header."""
    rows = spark.read.schema(schemas.PARAMETERS).option("header", True).csv(path)
    pairs = F.collect_list(F.struct("name", "value"))
    return rows.filter("name is not null").agg(F.map_from_entries(pairs).alias("params"))


def optional_csv(
    spark: SparkSession, path: str, key: str = "barcode", rename: dict[str, str] | None = None
) -> DataFrame | None:
    """A CSV that may be missing; its first column becomes the key."""
    try:
        df = spark.read.option("header", True).option("inferSchema", True).csv(path)
    except AnalysisException as error:
        if _absent(error):
            return None
        raise
    df = df.withColumnRenamed(df.columns[0], key).drop("Unnamed: 0")
    return df.withColumnsRenamed(rename or {})


def cluster_files(spark: SparkSession, pattern: str) -> DataFrame:
    """All matching cluster files as (file, barcode, label) in one scan."""
    df = spark.read.schema(schemas.CLUSTERS).option("header", True).csv(pattern)
    stem = F.regexp_extract(F.input_file_name(), r"([^/]+?)(\.[^./]*)?$", 1)
    return df.select(
        stem.alias("file"), "barcode", F.concat("cluster", F.lit(" (Gene cluster)")).alias("label")
    )


def wide_clusters(long: DataFrame, files: list[str]) -> DataFrame:
    return long.groupBy("barcode").pivot("file", files).agg(F.first("label"))


def _absent(error: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in str(error)


def annotations(spark: SparkSession, path: str) -> DataFrame:
    """Annotation polygons from GeoJSON: a feature collection or a bare list.

    Features with several rings are skipped; of equally named features of a class
    the last one stays. Large files are read in splits; absent ones have no polygons.
    """
    try:
        records = json_records(spark, path, "features")
    except AnalysisException as error:
        if not _absent(error):
            raise
        return spark.createDataFrame(
            [], "region_class string, region_name string, ring array<struct<x: double, y: double>>"
        )
    features = records.select(
        F.struct("file", "block", "k").alias("i"), F.from_json("value", schemas.FEATURE).alias("f")
    )
    # Text coordinates keep ragged features apart from plain ones.
    rings = F.col("f.geometry.coordinates")
    flat = features.filter(F.size(rings) == 1).select(
        "i",
        F.col("f.properties.classification.name").alias("region_class"),
        F.col("f.properties.name").alias("region_name"),
        F.transform(
            rings[0], lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))
        ).alias("ring"),
    )
    return flat.groupBy("region_class", "region_name").agg(F.max_by("ring", "i").alias("ring"))


def nuclei(spark: SparkSession, path: str, types: DataFrame) -> DataFrame:
    """Cells from instance JSON with names and #rrggbb colours of their types.

    ``types`` has (type_id STRING, cell_type, rgb ARRAY<INT>).
    """
    records = json_records(spark, path, "nuc")
    cells = records.select(F.col("key").alias("cell_ids"), F.from_json("value", schemas.NUCLEUS).alias("n"))
    return name_types(
        cells.select(
            "cell_ids",
            F.col("n.centroid")[0].alias("cell_x"),
            F.col("n.centroid")[1].alias("cell_y"),
            F.col("n.type").cast("string").alias("type_id"),
            F.col("n.type_prob").alias("type_prob"),
        ),
        types,
    )


def name_types(cells: DataFrame, types: DataFrame) -> DataFrame:
    rgb = F.col("rgb")
    colour = F.format_string("#%02x%02x%02x", rgb[0], rgb[1], rgb[2])
    return cells.join(types.select("type_id", "cell_type", colour.alias("color")), "type_id", "left")


def type_info(spark: SparkSession, path: str) -> DataFrame:
    """{"0": ["name", [r, g, b]], ...} as (type_id, cell_type, rgb)."""
    text = spark.read.text(path, wholetext=True)
    entries = F.from_json("value", "map<string,array<string>>")
    rows = text.select(F.explode(entries).alias("type_id", "v"))
    return rows.select(
        "type_id", F.col("v")[0].alias("cell_type"), F.from_json(F.col("v")[1], "array<int>").alias("rgb")
    )


def colour_classes(pixels: DataFrame, classes: DataFrame) -> DataFrame:
    """(y, x, rgb) pixels with the class of their colour, -1 where unknown."""
    known = classes.select("rgb", "class_id")
    return pixels.join(known, "rgb", "left").withColumn(
        "class_id", F.coalesce("class_id", F.lit(-1))
    )


def allowed(name: str, value: str, options: list[str]) -> str:
    """Check a parameter against its allowed values."""
    if value not in options:
        raise ValueError(f"{name} must be one of {options}, got {value!r}")
    return value
