"""Exact top-k inner products by columnar branch-and-bound.

Candidates lie in vertical layout: one array per dimension. Scores grow dimension block
by block. After each block a candidate's best and worst possible score follow from what
it has and the mass (norm) that it and the query have left; candidates whose best falls
below the k-th worst are dropped and the columns compacted before the next block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 16  # dimensions between two prunings
QUERIES = 512  # queries of one block
ROWS = 16_384  # candidates of one block


def quantized(col: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component as long, null for vectors that take no part."""
    bad = F.exists(col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(col, lambda x: F.floor(F.lit(scale).cast("double") * x.cast("double")))
    return F.when(col.isNotNull() & ~bad, whole)


def _largest(values: np.ndarray) -> int:
    return max(int(values.max(initial=0)), -int(values.min(initial=0)))


class Columns:
    """One block of candidates in vertical layout, searched by many queries.

    The first dimension blocks run for a set of queries at once, while most candidates
    are alive for all of them.
    """

    def __init__(self, ids: np.ndarray, matrix: np.ndarray):
        self.ids, self.high = ids, _largest(matrix)
        self.exact = self.high**2 * max(1, matrix.shape[1]) < 2**52
        self.vertical = np.ascontiguousarray(matrix.T.astype(np.float64 if self.exact else object))
        self.mass = np.einsum("ij,ij->j", self.vertical, self.vertical) if self.exact else None

    def best(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        # sums that would leave the exact range of a double: whole numbers of any size
        large = np.array([
            not self.exact or max(n, self.high) * n * max(1, queries.shape[1]) >= 2**52 for n in map(_largest, queries)
        ], dtype=bool)
        if large.any():
            whole = self.vertical.astype(np.int64).astype(object) if self.exact else self.vertical
            for q, vector in zip(query_ids[large], queries[large], strict=True):
                score = vector.astype(object) @ whole
                there = np.flatnonzero(self.ids != q)
                order = sorted(there.tolist(), key=lambda i: (-score[i], self.ids[i]))[:k]
                yield int(q), self.ids[order], score[order]
            query_ids, queries = query_ids[~large], queries[~large]
        dims, queries = queries.shape[1], queries.astype(np.float64)
        order = np.argsort(-np.einsum("ij,ij->j", queries, queries), kind="stable")  # heavy dimensions bound best
        vertical = self.vertical[order]
        for start in range(0, len(query_ids), 64):
            group = slice(start, start + 64)
            q, mine = queries[group][:, order], query_ids[group]
            half = max(BLOCK, dims // 2 // BLOCK * BLOCK)
            score = q[:, :half] @ vertical[:half]
            left = np.maximum(self.mass - np.einsum("ij,ij->j", vertical[:half], vertical[:half]), 0.0)
            rest = np.sqrt(np.einsum("ij,ij->i", q[:, half:], q[:, half:]))
            reach = np.sqrt(left)[None, :] * rest[:, None] * (1 + 1e-12) + 1e-6
            score[mine[:, None] == self.ids[None, :]] = -np.inf
            worst = score - reach
            n = len(self.ids)
            floor = np.partition(worst, n - k, axis=1)[:, n - k] if n > k else np.full(len(mine), -np.inf)
            keep = score + reach >= floor[:, None]
            for row in range(len(mine)):
                alive = np.flatnonzero(keep[row] & (score[row] > -np.inf))
                yield int(mine[row]), *self._finish(q[row], vertical, alive, score[row, alive], left[alive], half, k)

    def _finish(self, query, vertical, alive, score, left, at, k):
        for start in range(at, len(query), BLOCK):
            part = vertical[start : start + BLOCK, alive]
            score = score + query[start : start + BLOCK] @ part
            rest = query[start + BLOCK :]
            if not len(rest) or len(alive) <= k:
                continue
            left = np.maximum(left - np.einsum("ij,ij->j", part, part), 0.0)
            reach = np.sqrt(left) * np.sqrt(float(rest @ rest)) * (1 + 1e-12) + 1e-6
            floor = np.partition(score - reach, len(alive) - k)[len(alive) - k]
            keep = score + reach >= floor
            alive, score, left = alive[keep], score[keep], left[keep]
        best = np.lexsort((self.ids[alive], -score))[:k]
        return self.ids[alive][best], score[best]


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest integer inner products of each query.

    Both inputs have vec_id and v, an array of longs of one common length. A query's own
    row is no candidate; ties go to the smaller vec_id. Null vectors and null ids take no
    part, rows of other lengths than the query's neither. With fewer candidates than k
    all are given; no queries or no candidates give no rows. A vec_id that repeats is a
    candidate once per row, and one query with the smallest of its vectors.

    Queries and candidates meet in blocks of bounded size: each query block is sent to
    each group of candidate rows, which keeps k rows per query, so what is shuffled after
    the search grows with queries x groups, not with pairs.
    """
    spark = vectors.sparkSession
    rows = vectors.filter(F.col("v").isNotNull() & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), "v"
    )
    asked = (
        queries.filter(F.col("v").isNotNull() & F.col("vec_id").isNotNull())
        .groupBy(F.col("vec_id").cast("long").alias("vec_id"))
        .agg(F.min("v").alias("v"))
    )
    n_rows, n_asked = rows.count(), asked.count()
    groups, parts = max(1, -(-n_rows // ROWS)), max(1, -(-n_asked // QUERIES))
    block = F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int")
    left = rows.select(block.alias("g"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("p"), "vec_id", "v", F.lit(False).alias("q"))
    right = asked.select(
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"),
        F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int").alias("p"),
        "vec_id", "v", F.lit(True).alias("q"),
    )

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        sizes = pdf["v"].map(len)
        for width in sizes.unique():
            here = pdf[sizes == width]
            ask, have = here[here["q"]], here[~here["q"]]
            if not len(ask) or not len(have):
                continue
            data = Columns(have["vec_id"].to_numpy(), np.array(have["v"].tolist(), dtype=np.int64).reshape(len(have), width))
            q = np.array(ask["v"].tolist(), dtype=np.int64).reshape(len(ask), width)
            for qid, ids, score in data.best(ask["vec_id"].to_numpy(), q, k):
                out.extend((qid, int(i), int(s)) for i, s in zip(ids, score, strict=True))
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")

    n = max(groups * parts, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    found = (
        left.unionByName(right)
        .repartition(n, "g", "p")
        .groupBy("g", "p")
        .applyInPandas(run, "query_id long, vec_id long, score long")
    )

    def merge(hits: DataFrame, *keys: str) -> DataFrame:
        listed = F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))
        return hits.groupBy(*keys).agg(F.slice(F.sort_array(listed), 1, k).alias("best"))

    some = merge(found.withColumn("part", F.pmod("vec_id", F.lit(64))), "query_id", "part")
    some = some.select("query_id", F.explode("best").alias("hit")).select(
        "query_id", F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.s")).alias("score")
    )
    best = merge(some, "query_id")
    return best.select("query_id", F.posexplode("best").alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.s")).alias("score")
    )
