"""Near-duplicate documents by ProbMinHash over weighted shingles.

Every distinct run of five words sends points of a Poisson process whose rate is the
shingle's count; a point falls on a random register, and each register keeps the
shingle of its earliest point. Two documents agree in a register with the probability
Jaccard of their weighted shingles. Points come in time order per shingle, so a shingle
stops as soon as its next point is later than the latest register of its document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .bands import Shingler, band_hashes, linked
from .repeats import packed_texts
from .rows import ROW, pieces, texts_of, utf8, with_row
from .shingles import contents, mix, shingles, unit, weighted

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 32, 4  # a pair at 0.8 shares no band with probability below 1e-7
CHUNK = 1 << 18  # bytes of text handled at once


def signatures(h: np.ndarray, owner: np.ndarray, weight: np.ndarray, n: int, registers: int) -> np.ndarray:
    """(n, registers): the shingle with the earliest point on each register; 0 where a row has none."""
    first = np.full(n * registers, np.inf)
    best = np.zeros(n * registers, np.uint64)
    time = np.zeros(len(h))
    turn = 0
    while len(h):
        turn += 1
        draw = mix(h + np.uint64(turn * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        time = time - np.log(unit(draw)) / weight
        late = first.reshape(n, registers).max(axis=1)
        alive = time < late[owner]
        h, owner, weight, time, draw = h[alive], owner[alive], weight[alive], time[alive], draw[alive]
        at = owner * registers + (mix(draw ^ np.uint64(0xD1B54A32D192ED03)) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(first, at, time)
        won = first[at] == time
        best[at[won]] = h[won]
    return best.reshape(n, registers)


def sketched(docs: DataFrame, k: int, bands: int, rows: int) -> DataFrame:
    """(id, c1, c2, bands) of the rows with words: hashes of the word sequence, and bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            keys = batch.column(ROW).to_numpy()
            for start, stop in pieces(offsets, CHUNK):
                part = offsets[start : stop + 1]
                there, c1, c2 = contents(data, part)
                if not len(there):
                    continue
                h, owner, count = weighted(*shingles(data, part, k))
                sig = signatures(h, owner, count, stop - start, bands * rows)[there]
                flat = band_hashes(sig, rows)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, flat.size + 1, bands, dtype=np.int32)), pa.array(flat.ravel())
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[start:stop][there]), pa.array(c1.view(np.int64)), pa.array(c2.view(np.int64)), lists],
                    ["id", "c1", "c2", "bands"],
                )

    return texts_of(docs, ROW, lower=True).mapInArrow(run, "id long, c1 long, c2 long, bands array<long>")


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a list of texts."""
    ends = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    return np.frombuffer(b"".join(texts), np.uint8), ends


def shingler(k: int) -> Shingler:
    """Runs of k words with their counts, of zstd-compressed texts."""

    def read(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        unpack = zstandard.ZstdDecompressor()
        return weighted(*shingles(*joined([unpack.decompress(z) for z in packed]), k))

    return read


def near_duplicates(
    docs: DataFrame,
    k: int = WORDS,
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """(_row, class_row, kept) for every row: its class, named by the smallest ``_row``.

    ``docs`` has doc_id and text; ``_row`` is added where it is not there yet.

    Words are runs of characters other than ASCII white space of the lower-cased text;
    shingles are runs of ``k`` words weighted by their counts, one shingle of all words
    where there are fewer. Rows of equal words are one class; other rows link where their
    probability Jaccard is at least ``similarity``, and classes are components of links.
    Null texts and texts without words are classes of their own. ``kept`` marks the row
    that names its class. An empty table gives no rows.
    """
    docs = with_row(docs)
    every = cut_lineage(sketched(docs, k, bands, rows))
    reps = every.groupBy("c1", "c2").agg(F.min("id").alias("id"))
    same = every.select(F.col("id").alias(ROW), "c1", "c2")
    items = every.join(reps.select("id"), "id", "left_semi").select("id", "bands")

    def texts(ids: DataFrame) -> DataFrame:
        lower = docs.select(ROW, F.lower("text").alias("text"))
        return packed_texts(lower).withColumnRenamed(ROW, "id").join(ids, "id", "left_semi")

    roots = linked(items, texts, shingler(k), similarity)
    named = reps.join(roots, "id", "left").select("c1", "c2", F.coalesce("root", "id").alias("class_row"))
    classes = same.join(named, ["c1", "c2"]).select(ROW, "class_row")
    return docs.select(ROW).join(classes, ROW, "left").select(
        ROW, F.coalesce("class_row", ROW).alias("class_row"), F.coalesce(F.col("class_row") == F.col(ROW), F.lit(True)).alias("kept")
    )
