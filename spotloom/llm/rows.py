"""Row identity, input columns and Arrow helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

ROW = "_row"


OWN_KEY = {"names one row": True}  # metadata of the key; a caller's column may have its name


def with_row(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Add ``_row``, a long that names one row; a table that has this key already stays as it is.

    It is the id itself where ids are present and unique. Otherwise (null or repeated
    ids) rows are numbered and written once, so that a lost task sees the same numbers.
    A caller's own column of that name is replaced.
    """
    if ROW in docs.columns and docs.schema[ROW].metadata == OWN_KEY:
        return docs
    others = [c for c in docs.columns if c != ROW]
    ids = docs.select(F.col(id_col).alias("i"))
    twice = ids.groupBy("i").agg(F.count("*").alias("n")).filter("n > 1 OR i IS NULL").limit(1)
    if not twice.take(1):
        return docs.select(*others, F.col(id_col).cast("long").alias(ROW, metadata=OWN_KEY))
    return cut_lineage(docs.select(*others, F.monotonically_increasing_id().alias(ROW, metadata=OWN_KEY)))


def texts_of(docs: DataFrame, *more: str, lower: bool = False) -> DataFrame:
    """The row key, the named columns and the text; other columns stay out of the way."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(*more, (F.lower(text) if lower else text).alias("text"))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text or binary column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, dtype=np.int64, count=len(column) + column.offset + 1)[column.offset :]
    size = int(offsets[-1]) if len(offsets) else 0
    flat = np.frombuffer(data, dtype=np.uint8, count=size) if data is not None and size else np.zeros(0, np.uint8)
    return flat, offsets


def pieces(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose bytes stay near ``limit``; a longer row stands alone."""
    n, start = len(offsets) - 1, 0
    while start < n:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        stop = min(n, max(stop, start + 1))
        yield start, stop
        start = stop


def binary_column(values: list[bytes]) -> pa.Array:
    return pa.array(values, type=pa.binary())
