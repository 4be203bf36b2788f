"""Pieces, licences, toxicity, sharding, packing and the pipeline."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from spotloom.llm import licenses, packing, pieces, sharding, toxicity
from spotloom.llm.shingles import mix

from .conftest import ODD_ROWS
from .test_dedup import classes

SF = "/root/testdata/sf0.01"
PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def test_pieces_decode_to_the_text(odd):
    found = pieces.decode(pieces.encode(odd, PIECES), PIECES).collect()
    assert len(found) == len(ODD_ROWS)
    assert all(r["decoded"] == (r["text"] or "") for r in found)


def test_pieces_do_not_depend_on_partitions(odd):
    def of(df):
        return sorted(str((r["doc_id"], r["text"], r["pieces"])) for r in pieces.encode(df, PIECES).collect())

    assert of(odd.repartition(1)) == of(odd.repartition(7))


def test_every_piece_and_nothing_else_is_looked_up():
    v = pieces.Vocabulary(PIECES)
    for width in (1, 2, 3, 7):
        known = [p for p in v.ids if len(p) == width]
        words = known + [p[:-1] + "\u4e00" for p in known]
        codes = np.array([[ord(c) for c in w] for w in words], np.uint64)
        raw = [v._key(codes[i : i + 1])[0] for i in range(len(words))]
        at, ids = v.lookup(np.array(raw, np.uint64))
        assert {words[i]: int(j) for i, j in zip(at, ids, strict=True)} == {w: v.ids[w] for w in words if w in v.ids}


def test_pieces_follow_the_lattice():
    v = pieces.Vocabulary(PIECES)

    def all_of(word):
        if not word:
            yield (), 1.0
        for k in range(1, len(word) + 1):
            if word[:k] in v.ids:
                for rest, p in all_of(word[k:]):
                    yield (v.ids[word[:k]], *rest), p * v.weight[v.ids[word[:k]]]

    want = dict(all_of(" thes"))
    total = sum(want.values())
    n = 6000
    ids, ends = pieces.segment(v, ["thes"] * n, mix(np.arange(n).astype(np.uint64)))
    seen = Counter(tuple(ids[a:b].tolist()) for a, b in zip(ends[:-1], ends[1:], strict=True))
    assert set(seen) <= set(want)
    for path, p in want.items():
        assert abs(seen.get(path, 0) / n - p / total) < 0.03
    long = "ab" * 40
    ids, _ = pieces.segment(v, [long], np.zeros(1, np.uint64))
    assert b"".join(v.surface[i] for i in ids) == b" " + long.encode()


def test_licences_found_and_background_left(documents):
    rows = [
        (1, "some words. Licensed under the Apache License, Version 2.0. more words", None, None, None),
        (2, "Released under the MIT License.", None, None, None),
        (3, "He lost his driving license after the accident at the court house.", None, None, None),
        (4, None, None, None, None),
        (5, "", None, None, None),
        (6, "this work is licensed under the gnu general public license, version 3.", None, None, None),
    ]
    docs = documents(rows)
    found = {r["_row"]: r for r in licenses.scan(docs, licenses.train(docs)).collect()}
    assert {i: r["family"] for i, r in found.items()} == {1: "apache-2.0", 2: "mit", 6: "gpl-3.0"}
    text = rows[0][1].encode()[found[1]["start"] : found[1]["end"]].decode()
    assert text == "Licensed under the Apache License, Version 2.0"
    assert licenses.scan(documents([]), licenses.train(docs)).collect() == []


def test_toxicity_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    grammar = toxicity.train(docs, labels)
    got = toxicity.score(docs, grammar, ["doc_id"]).join(labels, "doc_id").filter(toxicity.held_out("doc_id")).collect()
    right = sum((r["score"] >= 0.5) == (r["toxic"] == 1) for r in got)
    assert right / len(got) > 0.95


def test_toxicity_of_odd_rows(odd, spark):
    grammar = toxicity.Grammar({"vile": 5.0}, np.array([-3.0, 1.0, 0, 0, 0, 0]))
    got = toxicity.score(odd, grammar, odd.columns).collect()
    assert len(got) == len(ODD_ROWS) and all(0 <= r["score"] <= 1 for r in got)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert all(r["score"] < 0.5 for r in toxicity.score(odd, toxicity.train(odd, none), ["doc_id"]).collect())


def test_clauses_weigh_by_what_surrounds():
    g = toxicity.Grammar({"vile": 4.0})

    def weight(text):
        return g.features(text)[0]

    plain = weight("that is vile")
    assert weight("you are vile") > plain > weight("that is not vile")
    assert weight("he said it was vile") < weight("he is vile")
    assert weight("a vileness") == weight("a vile") and weight("evile") == 0
    assert weight("vile. vile") == weight("vile")


def test_threats_compose_with_what_surrounds():
    g = toxicity.Grammar({})

    def weight(text):
        return g.features(text)[0]

    verb, aimed = weight("they of the far cold north burn wood"), weight("i will burn you")
    assert weight("to burn wood") == toxicity.VERB and weight("burning") == 0
    assert aimed == toxicity.AIMED * toxicity.RAISE > verb
    assert weight("ich werde dich töten") == aimed and weight("te voy a matar") == aimed
    assert weight("i will not burn you") == toxicity.LOWER_NEGATED * aimed
    assert weight("it said i will burn you") == pytest.approx(toxicity.LOWER_REPORTED * aimed)
    assert weight("kill you or hurt you") == 2 * aimed
    far = "kill " + "and so on " * 3 + "you"
    assert weight(far) == toxicity.VERB * toxicity.RAISE


def test_a_threat_verb_leaves_learned_entries():
    g = toxicity.Grammar({"kill": 6.0, "burn ": 5.0, "burn": 2.0})
    assert g.features("kill")[0] == 6 and g.features("killer")[0] == 6
    assert g.features("burn")[0] == 5 and g.features("burner")[0] == 2
    assert g.features("kill you")[0] == 6 * toxicity.RAISE


def check_shards(rows, n, shards=16):
    assert len(rows) == n
    sizes = Counter(r["shard"] for r in rows)
    assert max(sizes.values()) - min(sizes.get(s, 0) for s in range(shards)) <= 1
    for s in sizes:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sizes[s]))


def test_shards_keep_links_and_sizes(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sharding.shard(docs).collect()
    check_shards(rows, docs.count())
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert all(r["size"] == len(text[r["doc_id"]].encode()) + 1 for r in rows)
    assert all(r["text_crc32"] == zlib.crc32(text[r["doc_id"]].encode()) for r in rows)
    spread = Counter(len(s) for s in group(rows).values())
    assert sum(k for size, k in spread.items() if size > 1) <= 15  # a cut crosses one group at most


def group(rows):
    out = {}
    for r in rows:
        out.setdefault(r["text_crc32"], set()).add(r["shard"])
    return out


def test_a_group_beyond_one_shard_and_odd_rows(documents, odd):
    many = documents([(i, "same" if i < 300 else f"text {i}", None, None, None) for i in range(600)])
    rows = sharding.shard(many, 8).collect()
    check_shards(rows, 600, 8)
    assert len(group(rows)[zlib.crc32(b"same")]) <= 6  # half of all rows need four of the eight
    check_shards(sharding.shard(odd).collect(), len(ODD_ROWS))
    assert sharding.shard(documents([])).collect() == []


def check_pieces(rows, texts):
    tokenizer = Tokenizer.from_file(WORDS)
    ids = {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for i, t in texts.items()}
    for i, want in ids.items():
        mine = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["start"])
        assert [r["start"] for r in mine] == np.cumsum([0, *(r["length"] for r in mine)])[:-1].tolist()
        assert sum(r["length"] for r in mine) == len(want) and all(r["doc_tokens"] == len(want) for r in mine)
        for r in mine:
            part = np.array(want[r["start"] : r["start"] + r["length"]], "<u4").tobytes()
            assert r["ids_crc32"] == zlib.crc32(part)
    place = sorted((r["sequence_id"], r["offset"], r["length"]) for r in rows)
    at = 0
    for sequence, offset, size in place:
        assert sequence * 4096 + offset == at and offset + size <= 4096
        at += size


def test_packing_round_trip(spark, documents):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check_pieces(packing.pack(docs, WORDS).collect(), {r["doc_id"]: r["text"] for r in docs.collect()})
    odd = [(n, *r[1:]) for n, r in enumerate(ODD_ROWS)]
    odd += [(20, "x\x1cy z \x85 ΣΑΣ İSTANBUL 's DON'T <|endoftext|> ǅ", None, None, None)]
    check_pieces(packing.pack(documents(odd), WORDS).collect(), {r[0]: r[1] for r in odd})
    assert packing.pack(documents([]), WORDS).collect() == []


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    clean = corpus_pipeline.drop_toxic(spark, docs, SF)
    assert clean.columns == docs.columns
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    gone = {r["doc_id"] for r in docs.collect()} - {r["doc_id"] for r in clean.collect()}
    known = [i for i in gone if i in labels]
    assert sum(labels[i] for i in known) >= 0.9 * len(known)
    rows = docs.limit(300)
    kept = corpus_pipeline.drop_near_duplicates(spark, rows, SF)
    assert kept.columns == docs.columns and 0 < kept.count() < 300
    cut = corpus_pipeline.cut_repeats(spark, rows, SF)
    assert cut.columns == docs.columns and cut.count() == 300
    assert cut.filter(F.col("n_chars") != F.length("text")).count() == rows.filter(F.col("n_chars") != F.length("text")).count()
    assert corpus_pipeline.pack(spark, rows, SF).agg(F.count_distinct("doc_id")).first()[0] == 300


def test_few_toxic_rows_stay(spark):
    """sf0.001 has too few labelled rows to learn all words from: 4 of its 11 toxic rows stay."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    stay = {r["doc_id"] for r in corpus_pipeline.drop_toxic(spark, docs, SF).select("doc_id").collect()}
    toxic = {r["doc_id"] for r in labels.filter("toxic = 1").collect()}
    assert len(toxic) > 20 and len(toxic & stay) <= 0.1 * len(toxic)


def test_pipeline_is_the_chain_of_its_stages(spark):
    """Scores row by row, then near-duplicate classes, repeated strings and ids by brute force."""
    small = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    grammar = toxicity.train(docs, labels)
    texts = {r["doc_id"]: r["text"] for r in docs.orderBy("doc_id").collect()}
    clean = {
        i: t for i, t in texts.items() if grammar.scores(np.array([grammar.features((t or "").lower())]))[0] < 0.5
    }
    root = classes(clean)
    kept = {i: (t or "").encode() for i, t in clean.items() if root[i] == i}
    seen = Counter(b[p : p + 200] for b in kept.values() for p in range(len(b) - 199))
    rest = {}
    for i, b in kept.items():
        hit = bytearray(len(b))
        for p in range(len(b) - 199):
            if seen[b[p : p + 200]] > 1:
                hit[p : p + 200] = b"\1" * 200
        rest[i] = bytes(x for x, m in zip(b, hit, strict=True) if not m).decode("utf-8", "ignore")
    assert 0 < len(kept) < len(clean) < len(texts)
    rows = corpus_pipeline.run(spark, small).collect()
    assert {r["doc_id"] for r in rows} == set(rest)
    check_pieces(rows, rest)


@pytest.mark.parametrize("number", [1, 2, 3])
def test_pipeline_stages_take_odd_rows(spark, odd, number):
    name, stage = corpus_pipeline.STAGES[number]
    out = stage(spark, odd, SF)
    assert out.count() >= (1 if number == 1 else len(ODD_ROWS))


def with_clashes(docs):
    names = ("_row", "id", "score", "pieces", "_seed", "decoded", "kept", "label", "start", "n", "band", "cluster", "_lower")
    return docs.withColumns({c: F.lit(5) for c in names})


@pytest.mark.parametrize("number", [0, 1, 2, 3])
def test_pipeline_stages_ignore_clashing_columns(spark, number):
    """A constant long ``_row`` of the caller once multiplied rows."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(60)
    name, stage = corpus_pipeline.STAGES[number]
    want = sorted(map(str, stage(spark, docs, SF).collect()))
    got = sorted(map(str, stage(spark, with_clashes(docs), SF).collect()))
    assert got == want
    assert stage(spark, docs.limit(0), SF).collect() == []


def test_operators_ignore_clashing_columns(spark, documents):
    odd = documents(ODD_ROWS[:4]).withColumn("doc_id", F.monotonically_increasing_id())
    more = with_clashes(odd)
    model = public_tokenizers.path("piece_bpe_32k.model")
    encoded = pieces.encode(more, model)
    assert encoded.columns.count("pieces") == 1 and [r["_seed"] for r in encoded.collect()] == [5] * 4
    plain = {r["doc_id"]: r["pieces"] for r in pieces.encode(odd, model).collect()}
    assert {r["doc_id"]: r["pieces"] for r in encoded.collect()} == plain
    assert all(r["decoded"] == (r["text"] or "") for r in pieces.decode(encoded, model).collect())
    assert pieces.decode(pieces.encode(documents([]), model), model).collect() == []
    from spotloom.llm import paragraphs, probminhash, repeats

    for run in (sharding.shard, lambda d: packing.pack(d, WORDS), probminhash.near_duplicates, repeats.remove_repeats, paragraphs.removals):
        assert sorted(map(str, run(more).collect())) == sorted(map(str, run(odd).collect()))
    grammar = toxicity.Grammar({"bad ": 3.0})
    scored = toxicity.score(more, grammar, ["doc_id", "score", "_lower"])
    assert scored.columns == ["doc_id", "_lower", "score"] and scored.count() == 4
    assert toxicity.score(documents([]), grammar, ["doc_id"]).collect() == []


def test_background_sentences_come_from_whole_texts(spark):
    long = " ".join(f"sentence number {i} of a long text." for i in range(3000))
    docs = spark.createDataFrame([(1, long), (2, long), (3, None), (4, "")], "doc_id long, text string")
    every = licenses._background(docs, 100, 10_000)
    assert len(every) == len(set(every)) == 3000
    some = licenses._background(docs, 100, 300)
    assert 200 < len(some) < 400 and set(some) < set(every)
    places = [int(t.split()[2]) for t in some]
    assert min(places) < 300 and max(places) > 2700
    assert licenses._background(docs.limit(0), 100, 300) == []
