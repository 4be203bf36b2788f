"""Merkle manifest beside a plain recursive tree."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from spotloom.llm import manifest

from .conftest import ODD_ROWS


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([H("".join(low[i : i + 2])) for i in range(0, len(low), 2)])
    return levels


def leaf_of(row, more=0):
    doc_id, text, lang, source, n_chars = row
    if n_chars is not None:
        n_chars += more
    shown = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return H("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in shown))


def way(levels, pos):
    out = []
    for level in levels[:-1]:
        out.append(level[pos ^ 1] if pos ^ 1 < len(level) else "")
        pos >>= 1
    return out


def climb(digest, pos, siblings):
    for s in siblings:
        digest = H(s + digest if pos % 2 else digest + s)
        pos //= 2
    return digest


def expected(rows):
    langs = {}
    for row in rows:
        langs.setdefault(row[2], []).append(row)
    order = sorted(langs, key=lambda v: (v is not None, (v or "").encode()))
    trees, places = {}, {}
    for lang in order:
        mine = sorted(langs[lang], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        places[lang] = mine
        trees[lang] = tree([leaf_of(r) for r in mine])
    top = tree([trees[lang][-1][0] for lang in order])
    root = top[-1][0]
    out = []
    for g, lang in enumerate(order):
        over = way(top, g)
        for pos, row in enumerate(places[lang]):
            own = way(trees[lang], pos)
            bad = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            folded = climb(climb(leaf_of(row, 1 if bad else 0), pos, own), g, over)
            out.append((row[0], leaf_of(row), trees[lang][-1][0], root, H("".join(own + over)), folded, folded == root))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def tampered():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0


@pytest.mark.parametrize("bits, radix", [(0, 1), (2, 3), (12, 4)])
def test_manifest_matches_a_plain_tree(spark, documents, bits, radix):
    rows = [(i * 3 % 401, f"text {i}", ["en", "de", "fr", None, "en", "en", "日本"][i % 7], f"s{i % 5}", i) for i in range(333)]
    got = rows_of(manifest.manifest(documents(rows).repartition(5), tampered(), bits, radix))
    assert got == expected(rows)
    assert 0 < sum(not r[-1] for r in got) < 100


def test_many_small_groups(spark, documents):
    rows = [(i, "t", f"lang{i % 150}", "s", i) for i in range(200)]
    assert rows_of(manifest.manifest(documents(rows), tampered(), 2, 2)) == expected(rows)


def test_odd_rows_and_clashing_columns(spark, documents):
    want = expected(ODD_ROWS)
    odd = documents(ODD_ROWS).repartition(3)
    assert rows_of(manifest.manifest(odd, tampered(), 1, 2)) == want
    more = {c: F.lit(7) for c in ("g", "b", "pos", "n", "digest", "root", "path", "leaf", "_row")}
    assert rows_of(manifest.manifest(odd.withColumns(more), tampered())) == want
    big = documents([(1, "x", "en", None, 2**63 - 1), (21, "x", "en", None, 2**63 - 1)])
    assert rows_of(manifest.manifest(big, F.lit(True)))[0][-1] is False
    assert manifest.manifest(documents([]), tampered()).collect() == []
    assert rows_of(manifest.manifest(documents(ODD_ROWS[:1]), tampered())) == expected(ODD_ROWS[:1])
