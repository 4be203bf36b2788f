"""The operators on the given tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import codes, forest, licenses, manifest, packing, paragraphs, pieces, probminhash, repeats, sanitise, sharding, topk, toxicity
from .registry import query, table
from .rows import ROW, with_row


@query("op1_probminhash_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_row(table(spark, sf_dir, "documents").select("doc_id", "text"))
    classes = probminhash.near_duplicates(docs)
    named = docs.select(F.col(ROW).alias("class_row"), F.col("doc_id").alias("class_id"))
    return docs.select("doc_id", ROW).join(classes, ROW).join(named, "class_row").select("doc_id", "class_id", "kept")


@query("op2_suffix_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_row(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = repeats.remove_repeats(docs, texts=False).drop("kept", "kept_text")
    return docs.select("doc_id", ROW).join(removed, ROW).drop(ROW)


@query("op3_lattice_sampling")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    encoded = pieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    decoded = pieces.decode(encoded, path)
    return decoded.select(
        "doc_id",
        F.size("pieces").alias("n_pieces"),
        F.xxhash64("pieces").alias("pieces_hash"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("lossless"),
    )


@query("op4_label_propagation")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


@query("op5_license_classifier")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_row(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = licenses.scan(docs, licenses.train(docs))
    return docs.select("doc_id", ROW).join(found, ROW).drop(ROW)


@query("op6_projection_forest")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op7_clause_grammar")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    grammar = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, grammar, ["doc_id"])
    return scored.select(
        "doc_id",
        toxicity.held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query("op8_concat_cut")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op9_paragraph_minhash")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_row(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", ROW).join(paragraphs.removals(docs), ROW).drop(ROW)


_TOPK = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id != c.vec_id
  WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM pairs
)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 5
"""


@query("op10_branch_and_bound", _TOPK)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", topk.quantized(F.col("embedding")).alias("v"))
    return topk.top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


@query("op11_disclosure_sanitising")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_row(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = sanitise.sanitise(docs, ROW, texts=False)
    counts = [sanitise.how_many(k).alias(f"n_{k}") for k in sanitise.KINDS]
    return docs.select("doc_id", ROW).join(found, ROW).select(
        "doc_id", *counts, F.sha2(sanitise.listed(sanitise.KINDS), 256).alias("base_sha256"), sanitise.listed().alias("spans")
    )


_CODES = """
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v,
         row_number() OVER (ORDER BY vec_id) - 1 AS r
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT r, p.part, list_slice(v, p.part * (len(v) // 16) + 1, (p.part + 1) * (len(v) // 16)) AS x
  FROM kept, (SELECT range AS part FROM range(16)) p
), c0 AS MATERIALIZED (SELECT part, r AS entry, x AS c FROM parts WHERE r < 64),
{rounds}
, final AS MATERIALIZED ({assign2}
), coded AS (
  SELECT r, string_agg(lpad(format('{{:x}}', entry), 2, '0'), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM final GROUP BY r
), digest AS (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS s FROM c2
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, s AS codebooks_sha256
FROM coded JOIN kept USING (r) CROSS JOIN digest
"""


def _codes_sql() -> str:
    """Two rounds of the same statements over codebooks c0, c1 and c2."""
    assign = """
  SELECT r, part, x, entry, d FROM (
    SELECT p.r, p.part, p.x, b.entry,
           CAST(list_sum(list_transform(list_zip(p.x, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d,
           row_number() OVER (PARTITION BY p.r, p.part ORDER BY d, b.entry) AS place
    FROM parts p JOIN c{k} b USING (part)
  ) WHERE place = 1"""
    update = """
m{n} AS (
  SELECT part, entry, list(CAST(floor(s / n) AS BIGINT) ORDER BY j) AS c FROM (
    SELECT part, entry, j, sum(x[j]) AS s, count(*) AS n
    FROM a{k}, (SELECT range AS j FROM range(1, 1025)) g WHERE j <= len(x) GROUP BY part, entry, j
  ) GROUP BY part, entry
), c{n} AS MATERIALIZED (
  SELECT part, entry, coalesce(m{n}.c, c{k}.c) AS c FROM c{k} LEFT JOIN m{n} USING (part, entry)
)"""
    rounds = [f"a{k} AS MATERIALIZED ({assign.format(k=k)}\n),{update.format(k=k, n=k + 1)}" for k in (0, 1)]
    return _CODES.format(rounds=",\n".join(rounds), assign2=assign.format(k=2))


@query("op12_cover_tree_codes", _codes_sql())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = codes.encode(table(spark, sf_dir, "embeddings"), keep=["label"])
    totals = codes.total_by_label(coded, "label", "error", "label_error")
    digest = F.lit(codes.codebooks_digest(books))
    return totals.select("vec_id", "code", "error", "label_error", digest.alias("codebooks_sha256"))


_MANIFEST = """
WITH RECURSIVE fields AS (
  SELECT doc_id, lang, CAST(n_chars AS HUGEINT) AS n_chars,
         coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') AS f1,
         coalesce(strlen(source) || ':' || source, '-') AS f2,
         coalesce(strlen(lang) || ':' || lang, '-') AS f3,
         coalesce(strlen(text) || ':' || text, '-') AS f5,
         list_reduce(
           list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
           lambda a, b: list_reduce(
             list_prepend(xor(a, b), range(8)),
             lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)
         ) AS crc
  FROM documents
), leaves AS (
  SELECT doc_id, lang,
         sha256(f1 || f2 || f3 || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || f5) AS leaf,
         CASE WHEN xor(crc, 4294967295) % 7 = 0 AND n_chars IS NOT NULL
              THEN sha256(f1 || f2 || f3 || strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1) || f5) END AS other
  FROM fields
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY lang) AS n
  FROM leaves
), tree(lang, lvl, pos, digest, n) AS (
  SELECT lang, 0, pos, leaf, n FROM placed
  UNION ALL
  SELECT lang, lvl + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (n + 1) // 2
  FROM tree WHERE n > 1 GROUP BY lang, lvl, pos // 2, n
), subroots AS (
  SELECT lang, digest, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
  FROM tree WHERE n = 1
), top(lvl, pos, digest, n) AS (
  SELECT 0, pos, digest, n FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (n + 1) // 2
  FROM top WHERE n > 1 GROUP BY lvl, pos // 2, n
), ways AS (
  SELECT p.lang, p.pos, list(CASE WHEN (p.pos >> t.lvl) % 2 = 1 THEN 'L' ELSE 'R' END || coalesce(s.digest, '') ORDER BY t.lvl) AS way
  FROM placed p
  JOIN (SELECT DISTINCT lang, lvl FROM tree WHERE n > 1) t ON t.lang IS NOT DISTINCT FROM p.lang
  LEFT JOIN tree s ON s.lang IS NOT DISTINCT FROM p.lang AND s.lvl = t.lvl AND s.pos = xor(p.pos >> t.lvl, 1)
  GROUP BY p.lang, p.pos
), overs AS (
  SELECT p.lang, list(CASE WHEN (p.pos >> t.lvl) % 2 = 1 THEN 'L' ELSE 'R' END || coalesce(s.digest, '') ORDER BY t.lvl) AS way
  FROM subroots p
  CROSS JOIN (SELECT DISTINCT lvl FROM top WHERE n > 1) t
  LEFT JOIN top s ON s.lvl = t.lvl AND s.pos = xor(p.pos >> t.lvl, 1)
  GROUP BY p.lang
), whole AS (
  SELECT p.doc_id, p.leaf, u.digest AS subroot, (SELECT digest FROM top WHERE n = 1) AS root,
         coalesce(p.other, p.leaf) AS start,
         list_concat(coalesce(w.way, CAST([] AS VARCHAR[])), coalesce(o.way, CAST([] AS VARCHAR[]))) AS way
  FROM placed p
  JOIN subroots u ON u.lang IS NOT DISTINCT FROM p.lang
  LEFT JOIN ways w ON w.lang IS NOT DISTINCT FROM p.lang AND w.pos = p.pos
  LEFT JOIN overs o ON o.lang IS NOT DISTINCT FROM p.lang
), folded AS (
  SELECT doc_id, leaf, subroot, root,
         sha256(array_to_string(list_transform(way, lambda s: s[2:]), '')) AS proof_sha256,
         list_reduce(list_prepend(start, way), lambda a, s: sha256(CASE WHEN s[1] = 'L' THEN s[2:] || a ELSE a || s[2:] END)) AS folded_root
  FROM whole
)
SELECT *, folded_root = root AS verified FROM folded
"""


@query("op13_butterfly_manifest", _MANIFEST)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return manifest.manifest(table(spark, sf_dir, "documents"), tampered)
