"""Concatenate and cut: documents become one id stream, cut into fixed windows.

Two passes. The first encodes each document and keeps a running count of ids within
its partition; the partition totals are summed in order and give every partition its
place in the stream. The second cuts each document where the stream crosses a window
border and records the pieces. Only partition totals meet in one place.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .rows import binary_column, texts_of

# White space to str.split() that a tokenizer may treat as a character.
CONTROL = re.compile("[\x1c-\x1f]")
# Words whose normal form and parts are plain: Latin letters, then marks.
PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-įı-ɏ]+)([.,;:!?]*)")
PROBES = ["word", "Word.", "Straße,", "ÑANDÚ", "leçon!?", "ōsaka;", "A", "é"]
WORDS_KEPT = 600_000  # in each of two generations, about 200 MB per Python worker


def _byte_letters() -> dict[int, str]:
    """The characters that stand for bytes in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(hidden)}


class WordEncoder(dict):
    """Ids of whole texts, remembered by white-space separated words.

    The tokenizer never joins text across white space, so a text's ids are the ids of its
    words in order. A plain word that is new goes to the tokenizer's model directly, if
    that gives the tokenizer's own ids for some probes; other words and texts with
    control characters go through the tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.older, self.letters = self.tokenizer.model, {}, _byte_letters()
        self.direct = True
        normal = str(self.tokenizer.normalizer) + str(self.tokenizer.pre_tokenizer)
        self.direct = "Lowercase" in normal and "ByteLevel" in normal and all(
            self._plain(w) == self._whole(w) for w in PROBES
        )

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _plain(self, word: str) -> bytes | None:
        m = PLAIN.fullmatch(word) if self.direct else None
        if m is None:
            return None
        letters = m[1].lower()
        if not letters.isascii():
            letters = letters.encode().decode("latin-1").translate(self.letters)
        ids = np.array([t.id for t in self.model.tokenize(letters)], dtype="<u4").tobytes()
        return ids + self[m[2]] if m[2] else ids

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self._plain(word)
            if ids is None:
                ids = self._whole(word)
        self[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if CONTROL.search(text):
            return self._whole(text)
        if len(self) > WORDS_KEPT:
            self.older = dict(self)
            self.clear()
        return b"".join(map(self.__getitem__, text.split()))


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    """One encoder per worker, so that tasks share the words seen."""
    return WordEncoder(path)


def encode(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """(doc_id, part, before, n, ids): ids are packed, ``before`` counts within the part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, pack = WordEncoder(tokenizer), zstandard.ZstdCompressor(level=1)
        part, before, end = TaskContext.get().partitionId(), 0, np.array([end_id], "<u4").tobytes()
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for start in range(0, len(texts), 500):
                counts, packed = [], []
                for ids in map(encoder.encode, texts[start : start + 500]):
                    counts.append(len(ids) // 4 + 1)
                    packed.append(pack.compress(ids + end))
                sums = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(start, len(counts)),
                        pa.array(np.full(len(counts), part), pa.int32()),
                        pa.array(before + sums[:-1]),
                        pa.array(counts, pa.int64()),
                        binary_column(packed),
                    ],
                    ["doc_id", "part", "before", "n", "ids"],
                )
                before += int(sums[-1])

    slim = texts_of(docs, F.col("doc_id").cast("long").alias("doc_id"))
    return slim.mapInArrow(run, "doc_id long, part int, before long, n long, ids binary")


def pack(docs: DataFrame, tokenizer: str, length: int = 4096, end_id: int = 2) -> DataFrame:
    """One row per piece of a document: where its ids lie in which sequence.

    Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. A null
    text is empty and has the end id only; repeated rows are packed each; an empty table
    gives no rows. Only the last sequence is not full. A null doc_id is carried along.

    The encoded ids are written once to the checkpoint folder, so that both passes see
    the same order. The broadcast side has one row per input partition.
    """
    encoded = cut_lineage(encode(docs, tokenizer, end_id))
    totals = encoded.groupBy("part").agg(F.sum("n").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            at = batch.column("at").to_numpy()
            out: list[tuple] = []
            for doc, where, packed in zip(batch.column("doc_id").to_pylist(), at, batch.column("ids"), strict=True):
                ids, where = unpack.decompress(packed.as_py()), int(where)
                n, start = len(ids) // 4, 0
                while start < n:
                    offset = (where + start) % length
                    size = min(length - offset, n - start)
                    crc = zlib.crc32(ids[4 * start : 4 * (start + size)])
                    out.append((doc, start, size, crc, n, (where + start) // length, offset))
                    start += size
            columns = list(zip(*out, strict=True)) if out else [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    placed = encoded.join(F.broadcast(bases), "part").select(
        "doc_id", (F.col("base") + F.col("before")).alias("at"), "ids"
    )
    return placed.mapInArrow(
        cut,
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long",
    )
