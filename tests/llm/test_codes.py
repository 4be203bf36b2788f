"""Vector codes beside plain Lloyd rounds, and the tree's own promises."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spotloom.llm import codes

SCHEMA = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.DoubleType())),
        T.StructField("label", T.IntegerType()),
    ]
)


def expected(rows, parts=16, entries=64, rounds=2):
    """{(id, vector) -> (code, error)} and the digest, by comparing all with all in whole numbers."""
    kept = [(i, [int(np.floor(256 * x)) for x in v]) for i, v, *_ in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width = max(1, -(-max((len(v) for _, v in kept), default=0) // parts)) * parts
    kept = [(i, v + [0] * (width - len(v))) for i, v in kept]
    dims = width // parts
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[v[p * dims : (p + 1) * dims] for _, v in first] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for _, v in kept:
                x = v[p * dims : (p + 1) * dims]
                members.setdefault(nearest(x, books[p])[1], []).append(x)
            for e, xs in members.items():
                books[p][e] = [sum(c) // len(xs) for c in zip(*xs, strict=True)]
    out = []
    for i, v in kept:
        found = [nearest(v[p * dims : (p + 1) * dims], books[p]) for p in range(parts)]
        out.append((i, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found)))
    text = ",".join(str(c) for book in books for entry in book for c in entry)
    return sorted(out, key=repr), hashlib.sha256(text.encode()).hexdigest()


def rows_of(n, d=32, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, d)) * 0.2
    v = centres[rng.integers(0, 12, n)] + rng.standard_normal((n, d)) * 0.05
    return [(int(i), [float(x) for x in v[i]], int(i) % 5 if i % 3 else None) for i in rng.permutation(n)]


def check(df, rows, **options):
    coded, books = codes.encode(df, keep=["label"], **options)
    got = sorted(((r["vec_id"], r["code"], r["error"]) for r in coded.collect()), key=repr)
    want, digest = expected(rows)
    assert got == want and codes.codebooks_digest(books) == digest
    return coded, books


@pytest.mark.parametrize("block_rows, leaf_rows", [(37, 3), (8192, 16)])
def test_codes_match_plain_rounds(spark, block_rows, leaf_rows):
    rows = rows_of(300)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    coded, books = check(df, rows, block_rows=block_rows, leaf_rows=leaf_rows)
    by_label = codes.total_by_label(coded, "label", "error", "label_error").collect()
    sums = {}
    for r in by_label:
        sums[r["label"]] = sums.get(r["label"], 0) + r["error"]
    assert len(by_label) == 300 and all(r["label_error"] == sums[r["label"]] for r in by_label)
    back = codes.decode(coded, books).limit(20).collect()
    whole = {i: np.floor(256 * np.array(v)) for i, v, _ in rows}
    assert all(((whole[r["vec_id"]] - np.array(r["decoded"])) ** 2).sum() == r["error"] for r in back)


def test_labels_of_many_sizes(spark, monkeypatch):
    monkeypatch.setattr(codes, "HEAVY", 4)
    df = spark.range(400).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 40).alias("l"), F.lit(2).alias("e"))
    got = {tuple(r)[1:] for r in codes.total_by_label(df, "l", "e", "t").collect()}
    n = {}
    for i in range(400):
        n[i % 40 if i % 3 else None] = n.get(i % 40 if i % 3 else None, 0) + 1
    assert got == {(label, 2, 2 * k) for label, k in n.items()}


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(4, [0.5, -0.25, 1.0], 1), (4, [0.5, -0.25, 1.0], 1), (2, [0.0] * 17, None), (None, [1.0], 2), (9, [], None), (3, [-1e-9], 1)]
    bad = [(1, None, 1), (5, [1.0, None], 1), (6, [nan], None), (7, [inf, 1.0], 3), (8, [-inf], 3)]
    df = spark.createDataFrame(good + bad, SCHEMA).repartition(2)
    check(df, good)
    more = df.withColumns({c: F.lit("x") for c in ("v", "code", "error", "part", "id", "kept")})
    check(more, good)
    coded, books = codes.encode(spark.createDataFrame([], SCHEMA))
    assert coded.collect() == [] and books.shape[1] == 0
    huge, _ = codes.encode(spark.createDataFrame([(1, [1e300, -1e300], 1), (2, [0.0, 0.0], 1)], SCHEMA), entries=1)
    assert all(r["error"] >= 0 for r in huge.collect())


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 60), st.integers(1, 3), st.integers(1, 9), st.integers(1, 12), st.integers(0, 2**31))
def test_tree_assigns_like_brute_force(n, dims, spread, entries, seed):
    rng = np.random.default_rng(seed)
    points = rng.integers(-spread, spread + 1, (n, dims))
    book = rng.integers(-spread, spread + 1, (entries, dims))
    tree = codes.CoverTree.build(points, leaf_rows=2)
    assert sorted(tree.order) == list(range(n))
    found, total, count, _ = tree.assign(points, book)
    want = codes.distances(points, book).argmin(axis=1)
    assert (found == want).all() and (count == np.bincount(want, minlength=entries)).all()
    assert all((total[e] == points[want == e].sum(axis=0)).all() for e in range(entries))
    for low, high, centre, radius in zip(tree.start, tree.stop, tree.centre, tree.radius, strict=True):
        own = points[tree.order[low:high]]
        assert len(own) and np.sqrt(((own - points[centre]) ** 2).sum(axis=1)).max() <= radius + 1e-9


def test_far_nodes_are_assigned_whole():
    rng = np.random.default_rng(3)
    points = np.concatenate([rng.integers(0, 20, (400, 2)), rng.integers(1000, 1020, (400, 2))])
    tree = codes.CoverTree.build(points)
    assert tree.assign(points, np.array([[10, 10], [1010, 1010]]))[3] == 0
