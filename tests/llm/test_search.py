"""Embedding links and exact search beside brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spotloom.llm import forest, topk

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType()))])


def linked(rows):
    ok = [
        v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows
    ]
    unit = [np.array(v, np.float32).astype(float) / np.linalg.norm(np.array(v, np.float32).astype(float)) if k else None for (_, v), k in zip(rows, ok, strict=True)]
    n = len(rows)
    root, links = list(range(n)), [0] * n

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.9:
                links[i] += 1
                links[j] += 1
                root[max(find(i), find(j))] = min(find(i), find(j))
    return links, [find(i) for i in range(n)]


def clustered(n, seed):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((n // 6, 32))
    v = centres[rng.integers(0, len(centres), n)] + rng.standard_normal((n, 32)) * 0.22
    return [(i, [float(x) for x in v[i]]) for i in range(n)]


def test_links_match_brute_force(spark):
    rows = clustered(700, 2)
    got = {
        r["vec_id"]: r
        for r in forest.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(4), leaf=60).collect()
    }
    links, roots = linked(rows)
    found = sum(got[i]["n_links"] for i in range(700))
    assert all(got[i]["n_links"] <= links[i] for i in range(700))
    assert found >= 0.97 * sum(links) and sum(links) > 1000
    exact = {r["vec_id"]: r for r in forest.near_duplicates(spark.createDataFrame(rows, SCHEMA), leaf=10_000).collect()}
    assert [exact[i]["n_links"] for i in range(700)] == links
    assert [exact[i]["component_id"] for i in range(700)] == roots


def test_blocks_of_a_dense_leaf(spark, monkeypatch):
    monkeypatch.setattr(forest, "BLOCK", 16)
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in 1 + 0.2 * rng.standard_normal(16)]) for i in range(90)] + [(100, [0.0] * 15 + [1.0])]
    got = sorted(forest.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect())
    assert [r["n_links"] for r in got] == linked(rows)[0]


def test_odd_vectors(spark):
    v = [1.0, 2.0, 3.0]
    rows = [
        (5, v), (3, v), (4, [2.0, 4.0, 6.0]), (1, None), (2, [0.0, 0.0, 0.0]), (6, [1.0, None, 2.0]),
        (7, [float("nan"), 1.0, 1.0]), (8, [float("inf"), 1.0, 1.0]), (9, []), (10, [1.0, 2.0]),
    ]
    got = {r["vec_id"]: tuple(r)[1:] for r in forest.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[3] == (2, 3, True) and got[4] == (2, 3, False) and got[5] == (2, 3, False)
    assert all(got[i] == (0, i, True) for i in (1, 2, 6, 7, 8, 9, 10))
    twice = forest.near_duplicates(spark.createDataFrame(rows[:2] * 2 + [(None, v)], SCHEMA)).collect()
    assert sorted(r["n_links"] for r in twice) == [4] * 5 and {r["component_id"] for r in twice} == {3}
    assert forest.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def best(rows, queries, k):
    ints = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v in rows]
    out = []
    for q, v in [x for x in ints if x[0] in queries]:
        scores = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in ints if i != q)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores)]
    return sorted(out)


@pytest.mark.parametrize("scale", [1.0, 1e6])
def test_search_matches_brute_force(spark, monkeypatch, scale):
    monkeypatch.setattr(topk, "ROWS", 100)
    monkeypatch.setattr(topk, "QUERIES", 3)
    rows = [(i, [scale * x for x in v]) for i, v in clustered(400, 3)]
    df = spark.createDataFrame(rows, SCHEMA).select("vec_id", topk.quantized(F.col("embedding")).alias("v"))
    got = sorted(map(tuple, topk.top_k(df, df.filter("vec_id % 50 = 0")).collect()))
    assert got == best(rows, {i for i in range(0, 400, 50)}, 5)


def test_a_huge_query_among_ordinary_candidates():
    rng = np.random.default_rng(8)
    have, ids = rng.integers(-300, 300, (50, 16)), np.arange(50)
    ask = np.array([rng.integers(2**48, 2**49, 16) * 2 + 1, have[7]])
    got = {q: list(zip(i.tolist(), map(int, s), strict=True)) for q, i, s in topk.Columns(ids, have).best(np.array([90, 91]), ask, 5)}
    for q, v in zip((90, 91), ask.tolist(), strict=True):
        scores = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in enumerate(have.tolist()))[:5]
        assert got[q] == [(i, -s) for s, i in scores]


def test_odd_search(spark):
    rows = [(0, [1.0, 1.0]), (1, [1.0, 1.0]), (2, [1.0, 1.0]), (3, None), (50, [None, 1.0]), (100, [float("nan"), 1.0])]
    df = spark.createDataFrame(rows, SCHEMA).select("vec_id", topk.quantized(F.col("embedding")).alias("v"))
    got = sorted(map(tuple, topk.top_k(df, df.filter("vec_id % 50 = 0")).collect()))
    assert got == [(0, 1, 1, 131072), (0, 2, 2, 131072)]
    none = spark.createDataFrame([], SCHEMA).select("vec_id", topk.quantized(F.col("embedding")).alias("v"))
    assert topk.top_k(none, none).collect() == []
