"""Long repeats from an enhanced suffix array over content-chosen suffixes.

A suffix of every position would be some hundred bytes per input byte. Instead a
position is kept where a K-byte string has the smallest hash of some window of
``min_len`` bytes: two equal windows keep the same position, so every repeat of
``min_len`` bytes or more meets at kept suffixes. Suffixes that share their K bytes
form a bucket. A bucket's suffixes are sorted, their common prefix lengths scanned with
a stack, and each interval of the common-prefix tree is split by its left contexts: an
interval with diverse left extensions ends there, one with equal left bytes extends.
A group with left and right extensions of ``min_len`` together is a repeat, given with
all its occurrences.

Contexts that are equal in full are one row with a count. A bucket of more different
contexts than ``hot`` is halved by the window starts it answers for, each half keyed by
the longer string that all its windows share, until it is small or holds one window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .rows import ROW, pieces, texts_of, utf8, with_row
from .shingles import BASE, INVERSE, mix, powers

KEY = 48  # bytes that the suffixes of a bucket share
SEGMENT = 1 << 18  # bytes handled at once
HOT = 65_536  # different contexts of a bucket solved in one task, some 25 MB


def _slide(values: np.ndarray, width: int, op: np.ufunc) -> np.ndarray:
    """op over values[i : i + width] for every i, by doubling the reach."""
    n, reach = len(values) - width + 1, 1
    while 2 * reach <= width:
        values = op(values[:-reach], values[reach:])
        reach *= 2
    return op(values[:n], values[width - reach : width - reach + n])


def anchors(
    data: np.ndarray, offsets: np.ndarray, min_len: int, first: int = 0, last: int | None = None
) -> tuple[np.ndarray, ...]:
    """(row, position, hash, context id) of the kept K-byte strings of a few rows' bytes.

    A kept string has the least hash of a window that starts in [first, last). Row
    numbers count ``offsets``, positions count ``data``.
    """
    width, before, n = min_len - KEY + 1, min_len - KEY, len(data)
    if n < min_len:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    forward, back = _powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * forward[:n], dtype=np.uint64, out=sums[1:])

    def of(start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix(((sums[end] - sums[start]) * back[start]) ^ (end - start).astype(np.uint64))

    h = mix((sums[KEY:] - sums[:-KEY]) * back[: n - KEY + 1]) | np.uint64(1)
    low = _slide(h, width, np.minimum)
    ends = np.repeat(offsets[1:], np.diff(offsets))
    low[ends[: len(low)] - np.arange(len(low)) < min_len] = 0  # the window would leave its row
    low[:first] = 0
    if last is not None:
        low[last:] = 0
    padded = np.zeros(len(low) + 2 * (width - 1), np.uint64)
    padded[width - 1 : width - 1 + len(low)] = low
    at = np.flatnonzero(h == _slide(padded, width, np.maximum))
    row = np.searchsorted(offsets, at, side="right") - 1
    start, end = np.maximum(at - before, offsets[row]), np.minimum(at + min_len, offsets[row + 1])
    context = mix(of(start, at) ^ mix(of(at, end) + np.uint64(1)))
    return row, at, h[at].view(np.int64), context.view(np.int64)


@lru_cache(maxsize=1)
def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    return powers(BASE, n), powers(INVERSE, n)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and its inverse, kept for the usual sizes."""
    forward, back = _tables(max(3 * SEGMENT, n))
    return forward[:n], back[:n]


def _anchors_of(data: np.ndarray, offsets: np.ndarray, min_len: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(row number, position in the row, hash, context id), some rows or one row's segment at a time."""
    for start, stop in pieces(offsets, SEGMENT):
        low, high = int(offsets[start]), int(offsets[stop])
        if high - low <= 2 * SEGMENT:
            part = offsets[start : stop + 1] - low
            row, at, h, cid = anchors(data[low:high], part, min_len)
            yield row + start, at - part[row], h, cid
            continue
        for row in range(start, stop):  # a single long row
            begin, end, last = int(offsets[row]), int(offsets[row + 1]), -1
            for base in range(begin, end, SEGMENT):
                left, right = max(begin, base - min_len), min(end, base + SEGMENT + 2 * min_len)
                _, at, h, cid = anchors(
                    data[left:right], np.array([0, right - left]), min_len, base - left, base - left + SEGMENT
                )
                at = at + (left - begin)
                new = at > last
                if new.any():
                    last = int(at[-1])
                yield np.full(new.sum(), row), at[new], h[new], cid[new]


def suffixes(docs: DataFrame, min_len: int) -> DataFrame:
    """(h, cid, _row, pos): kept suffixes; ``cid`` names the whole context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            keys = batch.column(ROW).to_numpy()
            for row, pos, h, cid in _anchors_of(data, offsets, min_len):
                if len(row):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h), pa.array(cid), pa.array(keys[row]), pa.array(pos.astype(np.int32))],
                        ["h", "cid", ROW, "pos"],
                    )

    return texts_of(docs, ROW).mapInArrow(run, f"h long, cid long, {ROW} long, pos int")


def packed_texts(docs: DataFrame) -> DataFrame:
    """(_row, z): texts compressed for the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            view = memoryview(data)
            z = [pack.compress(view[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(ROW), pa.array(z, pa.binary())], [ROW, "z"])

    return texts_of(docs, ROW).mapInArrow(run, f"{ROW} long, z binary")


def _contexts(wanted: DataFrame, texts: DataFrame, min_len: int) -> DataFrame:
    """Bytes around each wanted suffix: (b, h, cid, n, lo, hi, lhs, rhs); lhs is reversed."""
    before = min_len - KEY

    names = ["b", "h", "cid", "n", "lo", "hi", "lhs", "rhs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            wants = batch.column("wants")
            flat = wants.flatten()
            h, cid, n, pos = (flat.field(x) for x in ("h", "cid", "n", "pos"))
            cuts = np.concatenate([[0], np.cumsum(wants.value_lengths().to_numpy())]).tolist()
            places, left, right = pos.to_pylist(), [], []
            for z, a, b in zip(batch.column("z"), cuts[:-1], cuts[1:], strict=True):
                text = unpack.decompress(z.as_py())
                for p in places[a:b]:
                    left.append(text[max(0, p - before) : p][::-1])
                    right.append(text[p : p + min_len])
            size = len(left)
            lo, hi = pa.array(np.zeros(size, np.int32)), pa.array(np.full(size, before, np.int32))
            both = [pa.array(left, pa.binary()), pa.array(right, pa.binary())]
            yield pa.RecordBatch.from_arrays([h, h, cid, n, lo, hi, *both], names)

    lists = wanted.groupBy(ROW).agg(F.collect_list(F.struct("h", "cid", "n", "pos")).alias("wants"))
    return lists.join(texts, ROW).select("z", "wants").mapInArrow(
        run, "b long, h long, cid long, n long, lo int, hi int, lhs binary, rhs binary"
    )


def _matrix(values: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Values as rows of equal width, and their lengths."""
    lengths = np.array([len(v) for v in values], dtype=np.int64)
    flat = np.frombuffer(b"".join(v.ljust(width, b"\0") for v in values), dtype=np.uint8)
    return flat.reshape(len(values), width), lengths


def _common(m: np.ndarray, lengths: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Common prefix lengths of the rows a and b."""
    differ = m[a] != m[b]
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), m.shape[1])
    return np.minimum(first, np.minimum(lengths[a], lengths[b]))


def _scan(lcp: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(first, last, common prefix) of every interval of the common-prefix tree."""
    stack: list[tuple[int, int]] = []
    for i, value in enumerate([*lcp.tolist(), -1], start=1):
        left = i - 1
        while stack and stack[-1][0] > value:
            depth, left = stack.pop()
            yield left, i - 1, depth
        if value >= 0 and (not stack or stack[-1][0] < value):
            stack.append((value, left))


def solve_bucket(
    lefts: list[bytes], rights: list[bytes], counts: list[int], min_len: int, groups: bool = True
) -> list[tuple]:
    """Repeats of one bucket, its rows sorted by ``rights``.

    Gives (group, row, left length, right length): row's context repeats with the other
    rows of the group, or with its own copies where its count is above one. Without
    ``groups`` an interval is left out for rows whose bytes a longer repeat covers.
    """
    out: list[tuple] = []
    group = 0
    covered = np.full(len(lefts), -1, np.int64)  # left reach of what a deeper interval gave
    for i, n in enumerate(counts):
        if n > 1 and len(lefts[i]) + len(rights[i]) >= min_len:
            out.append((group, i, len(lefts[i]), len(rights[i])))
            covered[i] = len(lefts[i])
            group += 1
    if len(lefts) < 2:
        return out
    m, lengths = _matrix(rights, min_len)
    seq = np.arange(1, len(rights))
    lcp = _common(m, lengths, seq - 1, seq)
    if len(lefts) == 2:
        need = min_len - int(lcp[0])
        reach = 0
        for x, y in zip(lefts[0], lefts[1], strict=False):
            if x != y:
                break
            reach += 1
        if reach >= need:
            out.extend((group, i, reach, int(lcp[0])) for i in (0, 1) if groups or reach > covered[i])
        return out
    lm, ll = _matrix(lefts, max(1, min_len - KEY))
    by_left = np.array(sorted(range(len(lefts)), key=lefts.__getitem__))
    place = np.empty(len(lefts), np.int64)
    place[by_left] = np.arange(len(lefts))
    for first, last, right in _scan(lcp):
        need = min_len - right
        members = by_left[np.sort(place[first : last + 1])]
        if not groups and covered[members].min() >= min_len - KEY:
            continue
        same = _common(lm, ll, members[:-1], members[1:])
        tied = same >= need  # equal left bytes: the repeat extends to the left
        if not tied.any():
            continue
        linked = np.where(tied, same, -1)
        reach = np.maximum(np.concatenate([[-1], linked]), np.concatenate([linked, [-1]]))
        number = group + np.cumsum(np.concatenate([[False], ~tied]))
        show = reach >= 0 if groups else reach > covered[members]
        for g, i, left in zip(number[show].tolist(), members[show].tolist(), reach[show].tolist(), strict=True):
            out.append((g, i, left, right))
        covered[members] = np.maximum(covered[members], reach)
        group = int(number[-1]) + 1
    return out


def _solve(buckets: DataFrame, min_len: int, groups: bool) -> DataFrame:
    """(b, grp, h, cid, lhs, rhs) of whole buckets of at most HOT contexts each."""

    def emit(rows: pd.DataFrame) -> Iterator[tuple]:
        b = rows["b"].to_numpy()
        cuts = np.concatenate([[0], np.flatnonzero(b[1:] != b[:-1]) + 1, [len(b)]])
        h, cid, n = rows["h"].to_numpy(), rows["cid"].to_numpy(), rows["n"].to_numpy()
        lefts, rights = rows["lhs"].tolist(), rows["rhs"].tolist()
        for start, stop in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            for group, i, left, right in solve_bucket(
                lefts[start:stop], rights[start:stop], n[start:stop].tolist(), min_len, groups
            ):
                yield int(b[start]), group, int(h[start + i]), int(cid[start + i]), left, right

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            last = batch["b"].to_numpy() == batch["b"].iloc[-1] if len(batch) else []
            if not len(batch):
                continue
            cut = int(np.argmax(last))
            yield pd.DataFrame(list(emit(batch.iloc[:cut])), columns=["b", "grp", "h", "cid", "lhs", "rhs"])
            rest = batch.iloc[cut:].reset_index(drop=True)
        if rest is not None and len(rest):
            yield pd.DataFrame(list(emit(rest)), columns=["b", "grp", "h", "cid", "lhs", "rhs"])

    n = int(buckets.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    ordered = buckets.repartition(n, "b").sortWithinPartitions("b", "rhs").select("b", "h", "cid", "n", "lhs", "rhs")
    return ordered.mapInPandas(run, "b long, grp long, h long, cid long, lhs int, rhs int")


def _solve_all(contexts: DataFrame, sizes: DataFrame, min_len: int, hot: int, groups: bool) -> DataFrame:
    """Solve small buckets; halve hot ones until they are small or one window wide."""
    done = _solve(contexts.join(sizes.filter(F.col("k") <= hot).select("b"), "b", "left_semi"), min_len, groups)
    large = sizes.filter(F.col("k") > hot)
    if not large.take(1):
        return done
    work = cut_lineage(contexts.join(large.select("b"), "b", "left_semi"))
    while True:
        one = work.filter("lo = hi").select(
            "b", F.lit(-1).cast("long").alias("grp"), "h", "cid", F.col("lo").alias("lhs"), (F.lit(min_len) - F.col("lo")).alias("rhs")
        )
        done = done.unionByName(one)
        mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
        wide = work.filter("lo < hi").withColumn("mid", mid)
        halves = wide.withColumn(
            "half",
            F.explode(
                F.array(
                    F.struct(F.col("lo").alias("l"), F.col("mid").alias("h")),
                    F.struct((F.col("mid") + 1).alias("l"), F.col("hi").alias("h")),
                )
            ),
        )
        lo, hi = F.col("half.l"), F.col("half.h")
        right = F.lit(min_len) - hi
        halves = halves.filter((F.length("lhs") >= lo) & (F.length("rhs") >= right)).select(
            F.xxhash64(
                F.col("b"), lo, hi, F.expr("substring(lhs, 1, half.l)"), F.expr(f"substring(rhs, 1, {min_len} - half.h)")
            ).alias("b"),
            "h", "cid", "n", lo.alias("lo"), hi.alias("hi"), "lhs", "rhs",
        )
        counted = halves.groupBy("b").agg(F.count("*").alias("k")).filter("k > 1")
        halves = cut_lineage(halves.join(counted, "b"))
        done = done.unionByName(_solve(halves.filter((F.col("k") <= hot) & (F.col("lo") < F.col("hi"))).drop("k"), min_len, groups))
        work = halves.filter((F.col("k") > hot) | (F.col("lo") == F.col("hi"))).drop("k")
        if not work.take(1):
            return done


def maximal_repeats(docs: DataFrame, min_len: int = 200, hot: int = HOT, groups: bool = True) -> DataFrame:
    """Groups of equal strings of ``min_len`` bytes or more with all their occurrences.

    Columns: b and grp (the group), _row, start, end (bytes). ``docs`` has ``_row`` and
    text. A repeat is seen through windows around kept suffixes, so one that is longer
    than about two windows comes as overlapping groups whose union it is. Groups of a
    single context (whole copies) have grp -2 and a b of their own. Without ``groups``, occurrences that a
    longer repeat around the same suffix covers are left out.
    """
    if not min_len > 2 * KEY:
        raise ValueError(f"min_len must exceed {2 * KEY}")
    before = min_len - KEY
    every = suffixes(docs, min_len)
    # written, so that both sides of the join are plain exchanges and a frequent key can be split
    again = cut_lineage(every.groupBy("h").agg(F.count("*").alias("k")).filter("k > 1").select("h"))
    shared = cut_lineage(every.join(again, "h", "left_semi"))
    distinct = shared.groupBy("h", "cid").agg(
        F.count("*").alias("n"), F.min(F.struct(ROW, "pos")).alias("at")
    )
    sizes = distinct.groupBy(F.col("h").alias("b")).agg(F.count("*").alias("k"))
    mixed = sizes.filter("k > 1")
    wanted = distinct.join(mixed.select(F.col("b").alias("h")), "h", "left_semi").select(
        "h", "cid", "n", F.col(f"at.{ROW}").alias(ROW), "at.pos"
    )
    contexts = _contexts(wanted, packed_texts(docs), min_len)
    solved = _solve_all(contexts, mixed, min_len, hot, groups)
    lengths = texts_of(docs, ROW).select(ROW, F.octet_length("text").alias("size"))
    parts = shared.join(solved, ["h", "cid"]).select(
        "b", "grp", ROW, (F.col("pos") - F.col("lhs")).alias("start"), (F.col("pos") + F.col("rhs")).alias("end")
    )
    # written for the same reason: a passage in a third of all rows is one key here
    twice = cut_lineage(distinct.filter("n > 1").select("h", "cid"))
    copies = (
        shared.join(twice, ["h", "cid"], "left_semi")
        .join(lengths, ROW)
        .select(
            F.xxhash64("h", "cid").alias("b"),
            F.lit(-2).cast("long").alias("grp"),
            ROW,
            F.greatest(F.col("pos") - before, F.lit(0)).alias("start"),
            F.least(F.col("pos") + min_len, F.col("size")).alias("end"),
        )
        .filter(F.col("end") - F.col("start") >= min_len)
    )
    return parts.unionByName(copies)


def merged(starts: list[int], ends: list[int]) -> list[tuple[int, int]]:
    """Union of ranges, given in order of their starts; touching ranges are one run."""
    out: list[list[int]] = []
    for s, e in zip(starts, ends, strict=True):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def remove_repeats(docs: DataFrame, min_len: int = 200, hot: int = HOT, texts: bool = True) -> DataFrame:
    """Remove each byte covered by a ``min_len``-byte string that also starts elsewhere.

    Columns: _row, n_bytes, n_removed, n_spans, kept (binary) and kept_text (without
    the halves of characters that were cut through), both null without ``texts``, and kept_sha256. ``docs`` has doc_id and text, or ``_row`` and text. A null text
    is empty; it and texts shorter than ``min_len`` lose nothing. Repeated rows are
    copies of each other and lose every byte that long strings cover. An empty table
    gives no rows. Overlapping occurrences within one text count.
    """
    docs = with_row(docs)
    spans = (
        maximal_repeats(docs, min_len, hot, groups=False)
        .groupBy(ROW, "start")
        .agg(F.max("end").alias("end"))
        .groupBy(ROW)
        .agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    )

    def shown(rest: bytes) -> tuple[bytes | None, str | None]:
        return (rest, rest.decode("utf-8", "ignore")) if texts else (None, None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            cols: list[list] = [[] for _ in range(6)]
            spans = batch.column("spans")
            starts, ends = (spans.flatten().field(x).to_pylist() for x in ("start", "end"))
            cuts = np.concatenate([[0], np.cumsum(spans.value_lengths().fill_null(0).to_numpy())]).tolist()
            for z, a, b in zip(batch.column("z"), cuts[:-1], cuts[1:], strict=True):
                text = unpack.decompress(z.as_py())
                runs = merged(starts[a:b], ends[a:b])
                kept, at = [], 0
                for s, e in runs:
                    kept.append(text[at:s])
                    at = e
                rest = b"".join([*kept, text[at:]])
                values = (len(text), len(text) - len(rest), len(runs), *shown(rest), hashlib.sha256(rest).hexdigest())
                for c, v in zip(cols, values, strict=True):
                    c.append(v)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(ROW), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))],
                [ROW, "n_bytes", "n_removed", "n_spans", "kept", "kept_text", "kept_sha256"],
            )

    return (
        packed_texts(docs)
        .join(spans, ROW, "left")
        .mapInArrow(run, f"{ROW} long, n_bytes long, n_removed long, n_spans long, kept binary, kept_text string, kept_sha256 string")
    )
