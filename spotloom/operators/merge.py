"""Putting per-stage tables together on spots and on cells."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import ratio

NOT_DECONVOLVED = "not deconvolved"
UNDEFINED = ("undefined", "Undefined")


def normalise_label(col: Column, lower: bool = True) -> Column:
    """' ' becomes '-', ',' is dropped, and case is folded."""
    text = F.regexp_replace(F.regexp_replace(col, " ", "-"), ",", "")
    return F.lower(text) if lower else text


def keep_deconvolved(cells: DataFrame) -> DataFrame:
    return cells.filter(~F.col("cell_type").isin(NOT_DECONVOLVED, *UNDEFINED))


def fill_cell_type(col: Column) -> Column:
    return F.coalesce(col, F.lit(NOT_DECONVOLVED))


def proportions(long: DataFrame, key: str = "barcode", value: str = "n") -> DataFrame:
    """Share of each type within its key; a key without any count gets zeros.

    ``long`` has one row per key and type, so a window group is at most as long as
    the list of types.
    """
    total = F.sum(value).over(Window.partitionBy(key))
    share = F.coalesce(ratio(F.col(value), total), F.lit(0.0))
    return long.select("*", share.alias("proportion"))


def wide_types(long: DataFrame, types: Sequence[str], value: str, key: str = "barcode") -> DataFrame:
    """One column per cell type (tens of them), zeros filled."""
    return (
        long.groupBy(key)
        .pivot("cell_type", list(types))
        .agg(F.sum(value))
        .na.fill(0)
    )


def reindex_to_spine(
    spine: DataFrame, data: DataFrame, key: str, fill: Sequence[str]
) -> DataFrame:
    """Rows of the spine in the data's columns; missing rows get zeros, extra rows go."""
    return spine.select(key).join(data, key, "left").na.fill(0, list(fill))


def reindex_report(spine: DataFrame, data: DataFrame, key: str) -> DataFrame:
    """How many keys had to be added and how many were dropped."""
    side = spine.select(key, F.lit(1).alias("s"), F.lit(0).alias("d")).unionByName(
        data.select(key, F.lit(0).alias("s"), F.lit(1).alias("d"))
    )
    flags = side.groupBy(key).agg(F.max("s").alias("s"), F.max("d").alias("d"))
    return flags.agg(
        F.count_if((F.col("s") == 1) & (F.col("d") == 0)).alias("added"),
        F.count_if((F.col("s") == 0) & (F.col("d") == 1)).alias("dropped"),
    )


def merge_on(key: str, *tables: DataFrame | None, how: str = "left") -> DataFrame:
    """Join the tables that exist; the first is the spine."""
    present = [t for t in tables if t is not None]
    result = present[0]
    for other in present[1:]:
        result = result.join(other, key, how)
    return result


def tag_clusterings(files: Mapping[str, DataFrame], key: str = "barcode") -> DataFrame:
    """One text column per clustering file, joined on the key from all sides.

    ``files`` maps a column name to (key, cluster) rows.
    """
    long = None
    for name, df in files.items():
        tagged = df.select(
            F.col(df.columns[0]).alias(key),
            F.lit(name).alias("_file"),
            F.concat(F.col(df.columns[1]).cast("string"), F.lit(" (Gene cluster)")).alias("_label"),
        )
        long = tagged if long is None else long.unionByName(tagged)
    return long.groupBy(key).pivot("_file", list(files)).agg(F.first("_label"))


def piechart_strings(
    long: DataFrame, types: Sequence[str], key: str = "barcode", value: str = "proportion"
) -> DataFrame:
    """Proportions rounded to two digits and joined by ';' in the order of ``types``."""
    wide = wide_types(long, types, value, key)
    parts = [F.bround(F.col(f"`{t}`"), 2).cast("string") for t in types]
    return wide.select(key, F.concat_ws(";", *parts).alias("pie"))


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key in the given order, by a fold instead of a sort."""
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*order)
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), rank).alias("_row"))
        .select(*keys, "_row.*")
    )


def cells_with_spot(cells: DataFrame) -> DataFrame:
    return cells.filter(F.col("barcode").isNotNull())


def align_ids(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Shift the left ids so that both sides start at the same id (never downwards)."""
    low_left = left.agg(F.min(key)).scalar()
    low_right = right.agg(F.min(key)).scalar()
    return left.withColumn(key, F.col(key) + F.greatest(low_right - low_left, F.lit(0)))


def chord_edges(matrix: DataFrame, cutoff: float = 0.0001) -> DataFrame:
    """Strongest row of every unordered pair of types, without self pairs."""
    pair = F.array_sort(F.array("source_name", "target_name"))
    kept = keep_first(
        matrix.withColumn("_pair", F.concat(pair[0], pair[1])),
        ["_pair"],
        [F.col("source_name"), -F.col("value"), F.col("target_name")],
    )
    return kept.filter(
        (F.col("source_name") != F.col("target_name")) & (F.col("value") >= cutoff)
    ).select("source_name", "target_name", "value")


def window_share(df: DataFrame, keys: Sequence[str], value: str, out: str = "share") -> DataFrame:
    """Share of a value in its group for small groups (levels, types)."""
    w = Window.partitionBy(*keys)
    return df.withColumn(out, ratio(F.col(value), F.sum(value).over(w)))
