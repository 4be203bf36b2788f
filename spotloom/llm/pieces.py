"""Sampled segmentations over a piece lattice, and decoding that gives the text back.

A word's lattice has its character borders as nodes and vocabulary pieces as arcs. The
forward filter sums arc weights up to every node; sampling goes backward from the end,
drawing each arc by its share of the sum. Draws come from a hash of the row's key, the
word's place and the step, so a row gives the same pieces wherever and whenever it runs.
Characters that no piece covers become byte pieces, which makes every text decodable.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, count

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  pa.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shingles import BASE, INVERSE, mix, powers, unit

SPACE_MARK = "▁"
WORD = re.compile(" *[^ ]+| +")
CHARS = 1_500_000  # characters handled at once, so that few words come twice
LONG = 32  # words of more characters get a lattice of their own
TABLE = 1 << 20
FIRST = np.uint64(64 - 20)  # shift to the bits that choose a slot of the first table
SPREAD = np.uint64(0x9E3779B97F4A7C15)


class Vocabulary:
    """Pieces of a sentencepiece model as arcs, with weights for sampling.

    A unigram model's scores are log probabilities. A BPE model's scores are negative
    ranks; these become the weights of a rank-frequency law, 1 / (2 + rank).
    ``theta`` is the inverse temperature: large values approach the best segmentation.
    """

    def __init__(self, path: str, theta: float = 1.0):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.bytes = np.full(256, -1, np.int32)
        self.surface: list[bytes] = [b""] * n
        plain: dict[str, int] = {}
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[1:-1], 16)] = i
                self.surface[i] = bytes([int(piece[1:-1], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                text = piece.replace(SPACE_MARK, " ")
                if " " not in text.lstrip(" "):  # words never share a piece
                    plain[text] = i
                    self.surface[i] = text.encode()
        if (self.bytes < 0).any():
            raise ValueError("the model has no byte pieces, so not every text can be encoded")
        ids = np.array(sorted(plain.values()), np.int32)
        score = np.array([model.get_score(int(i)) for i in ids])
        logs = score if score.min() > -100 else -np.log(2.0 + np.abs(score))
        self.weight = np.zeros(n)
        self.weight[ids] = np.exp(theta * (logs - logs.max()))
        self.byte_weight = float(self.weight[ids].min())
        self.longest = max(map(len, plain))
        self.ids = plain
        self._table(plain)
        self.lengths = np.array([len(s) for s in self.surface], np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.lengths)])[:-1]
        self.flat = np.frombuffer(b"".join(self.surface), np.uint8)

    def _table(self, plain: dict[str, int]) -> None:
        """Two small tables of places in ``found``; the second has the pieces whose slot in the first is taken."""
        self.found = np.array([-1, *plain.values()], np.int32)
        keys = [self._key(np.array([[ord(c) for c in p]], np.uint64))[0] for p in plain]
        self.keys = np.array([0, *keys], np.uint64)
        spread = self.keys * SPREAD
        self.slots = np.zeros((2, TABLE), np.int32)
        slot = (spread >> FIRST).astype(np.int64)
        _, first = np.unique(slot[1:], return_index=True)
        self.slots[0, slot[first + 1]] = first + 1
        rest = np.setdiff1d(np.arange(1, len(self.keys)), first + 1)
        for self.shift in range(10, 44):
            second = ((spread[rest] >> np.uint64(self.shift)) & np.uint64(TABLE - 1)).astype(np.int64)
            if len(np.unique(second)) == len(second):
                break
        else:
            raise ValueError("the vocabulary is too large for the table")
        self.slots[1, second] = rest

    @staticmethod
    def _key(codes: np.ndarray) -> np.ndarray:
        width = codes.shape[1]
        raw = ((codes + np.uint64(1)) * powers(BASE, width)).sum(axis=1, dtype=np.uint64)
        return raw ^ (np.uint64(width) << np.uint64(56))

    def lookup(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, id) of the keys that are pieces; most others end at an empty slot."""
        spread = keys * SPREAD
        place = self.slots[0][(spread >> FIRST).view(np.int64)]
        at = np.flatnonzero(place)
        place = place[at]
        other = np.flatnonzero(self.keys[place] != keys[at])
        there = ((spread[at[other]] >> np.uint64(self.shift)) & np.uint64(TABLE - 1)).view(np.int64)
        second = self.slots[1][there]
        place[other] = np.where(self.keys[second] == keys[at[other]], second, 0)
        known = place > 0
        return at[known], self.found[place[known]]

    def lattice(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(shares, arcs) of words of one length: shares[w, end, k] is cumulative over arcs of length k + 1.

        An arc below zero is a character in bytes: minus the code point, less one.
        """
        n, width = codes.shape
        reach = min(width, self.longest)
        sums = np.zeros((width + 1, n), np.uint64)
        sums[1:] = np.cumsum((codes + np.uint64(1)) * powers(BASE, width), axis=1, dtype=np.uint64).T
        back = powers(INVERSE, width + 1)
        forward = np.zeros((width + 1, n))
        forward[0] = 1.0
        shares = np.zeros((n, width + 1, reach), np.float32)
        arcs = np.full((n, width + 1, reach), -1, np.int32)
        for end in range(1, width + 1):
            here = np.zeros((n, reach))
            for k in range(min(end, reach)):
                start = end - k - 1
                if k == 0:  # bytes, where no piece is found
                    code = codes[:, start].astype(np.int64)
                    size = 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)
                    arcs[:, end, 0] = -1 - code
                    here[:, 0] = forward[start] * self.byte_weight**size
                key = ((sums[end] - sums[start]) * back[start]) ^ (np.uint64(k + 1) << np.uint64(56))
                at, ids = self.lookup(key)
                if len(at):
                    arcs[at, end, k] = ids
                    here[at, k] = forward[start][at] * self.weight[ids]
            total = here.sum(axis=1)
            shares[:, end] = np.cumsum(here, axis=1) / total[:, None]
            # keep the scale: only ratios matter
            forward[end] = total
            if end % 8 == 0:
                forward[: end + 1] /= forward[max(0, end - self.longest) : end + 1].max(axis=0)
        return shares, arcs


def _long_word(v: Vocabulary, word: str, seed: np.uint64) -> list[int]:
    """Arcs of one long word, in text order, by the same filter and sampling."""
    n = len(word)
    logs = np.zeros(n + 1)
    steps: list[list[tuple[int, int, float]]] = [[] for _ in range(n + 1)]
    for end in range(1, n + 1):
        for k in range(1, min(end, v.longest) + 1):
            piece = v.ids.get(word[end - k : end])
            if piece is not None:
                steps[end].append((k, piece, logs[end - k] + float(np.log(v.weight[piece]))))
            elif k == 1:
                size = len(word[end - 1].encode())
                steps[end].append((1, -1 - ord(word[end - 1]), logs[end - 1] + size * float(np.log(v.byte_weight))))
        top = max(s[2] for s in steps[end])
        logs[end] = top + float(np.log(sum(np.exp(s[2] - top) for s in steps[end])))
    out, end, turn = [], n, 0
    while end:
        turn += 1
        u = float(unit(mix(np.array([seed], np.uint64) + np.uint64(turn)))[0])
        for k, piece, log in steps[end]:
            u -= float(np.exp(log - logs[end]))
            if u <= 0:
                break
        out.append(piece)
        end -= k
    return out[::-1]


def segment(v: Vocabulary, texts: list[str], seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pieces, offsets): a sampled segmentation of each text; a space goes before it."""
    split = [WORD.findall(" " + t) if t else [] for t in texts]
    counts = np.array([len(s) for s in split], np.int64)
    number: defaultdict[str, int] = defaultdict(count().__next__)
    which = np.fromiter(map(number.__getitem__, chain.from_iterable(split)), np.int64, int(counts.sum()))
    if not len(which):
        return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
    doc = np.repeat(np.arange(len(texts)), counts)
    place = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
    seed = mix(seeds[doc] ^ mix(place.astype(np.uint64) + np.uint64(1)))
    distinct = list(number)
    sizes = np.array([len(w) for w in distinct])
    rank = np.zeros(len(distinct), np.int64)
    rows, order, values = [], [], []  # occurrence, step from its end, arc
    for width in np.unique(sizes):
        members = np.flatnonzero(sizes == width)
        rank[members] = np.arange(len(members))
        if width > LONG:
            continue
        for low in range(0, len(members), 20_000):
            some = members[low : low + 20_000]
            codes = np.frombuffer("".join(distinct[i] for i in some).encode("utf-32-le"), np.uint32)
            shares, arcs = v.lattice(codes.reshape(len(some), width).astype(np.uint64))
            mine = np.zeros(len(distinct), bool)
            mine[some] = True
            at = np.flatnonzero(mine[which])
            word, end, turn = rank[which[at]] - low, np.full(len(at), width), 0
            while len(at):
                turn += 1
                u = unit(mix(seed[at] + np.uint64(turn))).astype(np.float32)
                near = shares[word, end]
                k = np.minimum((near < u[:, None]).sum(axis=1), np.minimum(end, near.shape[1]) - 1)
                rows.append(at)
                order.append(np.full(len(at), turn, np.int32))
                values.append(arcs[word, end, k])
                end = end - k - 1
                more = end > 0
                at, word, end = at[more], word[more], end[more]
    for i in np.flatnonzero(sizes > LONG):
        for at in np.flatnonzero(which == i):
            found = _long_word(v, distinct[i], seed[at])[::-1]
            rows.append(np.full(len(found), at))
            order.append(np.arange(1, len(found) + 1))
            values.append(np.array(found, np.int64))
    rows, order = np.concatenate(rows), np.concatenate(order)
    values = np.concatenate(values).astype(np.int64)
    steps = np.bincount(rows, minlength=len(which))
    first = np.cumsum(steps) - steps
    arcs = np.empty(len(values), np.int64)
    arcs[first[rows] + steps[rows] - order] = values
    size = np.ones(len(arcs), np.int64)
    raw = np.flatnonzero(arcs < 0)
    spelled = [chr(-1 - c).encode() for c in arcs[raw].tolist()]
    size[raw] = [len(s) for s in spelled]
    ends = np.cumsum(size)
    out = np.repeat(arcs, size).astype(np.int32)
    if len(raw):
        where = np.repeat(ends[raw] - size[raw], size[raw]) + (
            np.arange(size[raw].sum()) - np.repeat(np.cumsum(size[raw]) - size[raw], size[raw])
        )
        out[where] = v.bytes[np.frombuffer(b"".join(spelled), np.uint8)]
    per_word = np.add.reduceat(size, first)
    offsets = np.concatenate([[0], np.cumsum(np.bincount(doc, per_word, len(texts)))]).astype(np.int64)
    return out, offsets


@lru_cache(maxsize=2)
def vocabulary(path: str, theta: float) -> Vocabulary:
    return Vocabulary(path, theta)


def encode(docs: DataFrame, model: str, theta: float = 1.0, seed: int = 0, key: str = "doc_id") -> DataFrame:
    """All columns and ``pieces``, a sampled segmentation of the text seeded by the row's key.

    A column ``pieces`` of the input is replaced. Null and empty texts give no pieces; an
    empty table gives no rows. Rows of equal key and text give equal pieces; a
    null key is a key of its own. ``model`` is a path that every executor can read.
    """
    columns = [c for c in docs.columns if c != "pieces"]
    hidden = max(columns, key=len) + "_"  # a name that no column has
    place = columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(model, theta)
        for batch in batches:
            texts = [t or "" for t in batch.column(place).to_pylist()]
            seeds = batch.column(len(columns)).to_numpy().astype(np.int64).view(np.uint64)
            start = 0
            while start < len(texts):
                stop, chars = start, 0
                while stop < len(texts) and (stop == start or chars + len(texts[stop]) <= CHARS):
                    chars += len(texts[stop])
                    stop += 1
                ids, ends = segment(v, texts[start:stop], mix(seeds[start:stop]))
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids, pa.int32()))
                part = [c.slice(start, stop - start) for c in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays([*part, lists], [*columns, "pieces"])
                start = stop

    schema = T.StructType([*docs.select(*columns).schema.fields, T.StructField("pieces", T.ArrayType(T.IntegerType()))])
    return docs.select(*columns, F.xxhash64(F.lit(seed), F.col(key)).alias(hidden)).mapInArrow(run, schema)


def decode(rows: DataFrame, model: str) -> DataFrame:
    """All columns and ``decoded``, the text of ``pieces``; a null list gives null.

    A column ``decoded`` of the input is replaced; an empty table gives no rows.
    """
    columns = [c for c in rows.columns if c != "decoded"]
    place = columns.index("pieces")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(model, 1.0)
        for batch in batches:
            lists = batch.column(place)
            if isinstance(lists, pa.ChunkedArray):
                lists = lists.combine_chunks()
            sizes = lists.value_lengths().fill_null(0).to_numpy()
            ids, out = lists.flatten().to_numpy(), []
            cuts = np.concatenate([[0], np.cumsum(sizes)])
            for low in range(0, len(sizes), 200):
                high = min(len(sizes), low + 200)
                some = ids[cuts[low] : cuts[high]]
                lengths = v.lengths[some]
                ends = np.concatenate([[0], np.cumsum(lengths)])
                flat = v.flat[np.repeat(v.offsets[some] - ends[:-1], lengths) + np.arange(ends[-1])].tobytes()
                edges = ends[cuts[low : high + 1] - cuts[low]].tolist()
                out += [flat[a + 1 : b].decode() if b > a else "" for a, b in zip(edges[:-1], edges[1:], strict=True)]
            texts = pa.array(out, pa.string())
            if lists.null_count:
                texts = pa.compute.if_else(lists.is_valid(), texts, pa.scalar(None, pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], [*columns, "decoded"])

    schema = T.StructType([*rows.select(*columns).schema.fields, T.StructField("decoded", T.StringType())])
    return rows.select(*columns).mapInArrow(run, schema)
