"""Partitioned readers for array files: count matrices, label masks, images.

Array files are read through Spark's Python data source API: the driver looks at
shapes only, and each task maps its own range of the file.
"""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, In, InputPartition


class Range(InputPartition):
    def __init__(self, low: int, high: int):
        self.low, self.high = low, high


def _ranges(n: int, size: int) -> list[Range]:
    return [Range(low, min(low + size, n)) for low in range(0, n, size)]


class MaskSource(DataSource):
    """``spark.read.format('npy_mask')``: foreground pixels of a 2-D label array."""

    @classmethod
    def name(cls) -> str:
        return "npy_mask"

    def schema(self) -> str:
        return "y int, x int, inst_id long"

    def reader(self, schema) -> DataSourceReader:
        return _MaskReader(self.options)


class _MaskReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.rows = int(options.get("rows_per_task", 1024))

    def partitions(self) -> list[Range]:
        return _ranges(np.load(self.path, mmap_mode="r").shape[0], self.rows)

    def read(self, partition: Range) -> Iterator:
        import pyarrow as pa

        mask = np.load(self.path, mmap_mode="r")
        for low in range(partition.low, partition.high, 64):
            part = np.asarray(mask[low : min(low + 64, partition.high)])
            y, x = np.nonzero(part)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array((y + low).astype(np.int32)),
                    pa.array(x.astype(np.int32)),
                    pa.array(part[y, x].astype(np.int64)),
                ],
                names=["y", "x", "inst_id"],
            )


class ImageSource(DataSource):
    """``spark.read.format('raster_image')``: pixels of an npy or TIFF image."""

    @classmethod
    def name(cls) -> str:
        return "raster_image"

    def schema(self) -> str:
        return "y int, x int, channel int, value double"

    def reader(self, schema) -> DataSourceReader:
        return _ImageReader(self.options)


class _ImageReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.rows = int(options.get("rows_per_task", 256))

    def _open(self):
        if Path(self.path).suffix == ".npy":
            return np.load(self.path, mmap_mode="r")
        try:
            import tifffile
        except ImportError as error:
            raise RuntimeError("reading TIFF needs the tifffile package") from error
        return tifffile.memmap(self.path, mode="r")

    def partitions(self) -> list[Range]:
        return _ranges(self._open().shape[0], self.rows)

    def read(self, partition: Range) -> Iterator:
        import pyarrow as pa

        image = self._open()
        for row in range(partition.low, partition.high, 16):
            part = np.asarray(image[row : min(row + 16, partition.high)])
            if part.ndim == 2:
                part = part[:, :, None]
            y, x, c = (i.ravel() for i in np.indices(part.shape, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(y + np.int32(row)), pa.array(x), pa.array(c), pa.array(part.ravel().astype(float))],
                names=["y", "x", "channel", "value"],
            )


class CountMatrixSource(DataSource):
    """``spark.read.format('count_matrix')``: column-compressed counts as COO rows.

    The path is an HDF5 matrix file, or a folder with indptr/indices/data/barcodes/
    gene_ids/gene_names as npy files. Tasks split the barcodes. Equality and IN filters on
    barcode, gene and gene_name, and lower bounds of count, are answered while reading: of
    barcodes that are left out neither indices nor counts are read, of genes no counts.
    """

    @classmethod
    def name(cls) -> str:
        return "count_matrix"

    def schema(self) -> str:
        return "barcode string, gene string, gene_name string, count long"

    def reader(self, schema) -> DataSourceReader:
        return _CountReader(self.options)


class _CountReader(DataSourceReader):
    PARTS = {
        "indptr": "matrix/indptr",
        "indices": "matrix/indices",
        "data": "matrix/data",
        "barcodes": "matrix/barcodes",
        "gene_ids": "matrix/features/id",
        "gene_names": "matrix/features/name",
    }

    def __init__(self, options):
        self.path = options["path"]
        self.columns = int(options.get("barcodes_per_task", 512))
        self.wanted: dict[str, set[str]] = {}
        self.above: int | float | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = f.attribute[0] if isinstance(f, EqualTo | In | GreaterThan) and len(f.attribute) == 1 else None
            if column in ("barcode", "gene", "gene_name") and isinstance(f, EqualTo | In):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted[column] = self.wanted.get(column, values) & values
            elif column == "count" and isinstance(f, GreaterThan) and f.value is not None:
                self.above = f.value if self.above is None else max(self.above, f.value)
            else:
                yield f

    def _hits(self, column: str, values: list[str]) -> np.ndarray:
        """Which values the filters of the column let through."""
        if column not in self.wanted:
            return np.ones(len(values), bool)
        return np.array([v in self.wanted[column] for v in values], bool)

    def _part(self, name: str, window: slice = slice(None)):
        if Path(self.path).is_dir():
            return np.load(Path(self.path) / f"{name}.npy", mmap_mode="r", allow_pickle=False)[window]
        try:
            import h5py
        except ImportError as error:
            raise RuntimeError("reading HDF5 matrices needs the h5py package") from error
        with h5py.File(self.path, "r") as file:
            return file[self.PARTS[name]][window]

    @staticmethod
    def _text(values) -> list[str]:
        return [v.decode() if isinstance(v, bytes) else str(v) for v in values]

    def partitions(self) -> list[Range]:
        return _ranges(len(self._part("indptr")) - 1, self.columns)

    def read(self, partition: Range) -> Iterator:
        import pyarrow as pa

        barcodes = self._text(self._part("barcodes", slice(partition.low, partition.high)))
        hits = self._hits("barcode", barcodes)
        if not hits.any():
            return
        genes, names = (self._text(self._part(c)) for c in ("gene_ids", "gene_names"))
        known = self._hits("gene", genes) & self._hits("gene_name", names)
        if not known.any():
            return
        edges = np.flatnonzero(np.diff(np.concatenate([[False], hits, [False]]).astype(np.int8)))
        gene_texts, name_texts = pa.array(genes), pa.array(names)
        for low, high in edges.reshape(-1, 2).tolist():  # barcodes that follow each other are read at once
            at = partition.low + low
            indptr = np.asarray(self._part("indptr", slice(at, partition.low + high + 1)), dtype=np.int64)
            window = slice(int(indptr[0]), int(indptr[-1]))
            index = np.asarray(self._part("indices", window), dtype=np.int64)
            keep = np.flatnonzero(known[index])
            if not len(keep):
                continue
            counts = np.asarray(self._part("data", window)[keep], dtype=np.int64)
            if self.above is not None:
                keep, counts = keep[counts > self.above], counts[counts > self.above]
            owner = np.repeat(np.arange(high - low), np.diff(indptr))[keep]
            index = pa.array(index[keep])
            yield pa.RecordBatch.from_arrays(
                [pa.array(barcodes[low:high]).take(pa.array(owner)), gene_texts.take(index), name_texts.take(index), pa.array(counts)],
                names=["barcode", "gene", "gene_name", "count"],
            )


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    for source in (MaskSource, ImageSource, CountMatrixSource):
        spark.dataSource.register(source)


def read_mask(spark: SparkSession, path: str, **options) -> DataFrame:
    register(spark)
    return spark.read.format("npy_mask").options(**options).load(path)


def read_counts(spark: SparkSession, path: str, **options) -> DataFrame:
    """Counts without zeros, deprecated probes, or genes that are never seen."""
    register(spark)
    return (
        spark.read.format("count_matrix")
        .options(**options)
        .load(path)
        .filter("count > 0 and not contains(gene_name, 'DEPRECATED')")
    )
