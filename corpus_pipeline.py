"""From raw documents to packed training sequences, in stages that each write their rows.

Toxic documents go, one document of each near-duplicate group stays, long repeats are
cut out of the texts, and what is left is packed. Every stage but the last gives the
columns of ``documents`` and sees only what the stage before it kept.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotloom.llm import packing, probminhash, repeats, toxicity
from spotloom.llm.registry import table
from spotloom.llm.rows import ROW, with_row
from spotloom.session import ensure_checkpoint_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the clause grammar scores below one half; the rest is rejected.

    Null and empty texts score alike and stay where texts without hits do; repeated rows
    go or stay together. Other columns are dropped, as in every stage; an empty table
    gives no rows.
    """
    grammar = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, grammar, COLUMNS).filter("score < 0.5").drop("score")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each near-duplicate class.

    Texts too short for a shingle, null and empty ones are near-duplicates of equal texts
    only. Null and repeated ids are rows of their own; an empty table gives no rows.
    """
    rows = with_row(docs.select(*COLUMNS))
    gone = probminhash.near_duplicates(rows).filter("NOT kept").select(ROW)
    return rows.join(gone, ROW, "left_anti").select(*COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without strings of 200 bytes that occur again; every document stays.

    A character that a cut splits goes with it. n_chars is the new length. A null text
    stays null, and repeated rows lose what they share; an empty table gives no rows.
    """
    rows = with_row(docs.select(*COLUMNS))
    kept = repeats.remove_repeats(rows).select(ROW, "kept_text", "n_removed")
    rest = rows.select(ROW, "doc_id", "lang", "source", F.col("n_chars").alias("old"), F.col("text").isNull().alias("none"))
    text = F.when(~F.col("none"), F.col("kept_text"))
    return rest.join(kept, ROW).select(
        "doc_id",
        text.alias("text"),
        "lang",
        "source",
        F.when(F.col("n_removed") == 0, F.col("old")).otherwise(F.length(text)).cast("long").alias("n_chars"),
    )


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 4096 ids; null and empty texts are their end id alone."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_dedup", drop_near_duplicates),
    ("suffix_dedup", cut_repeats),
    ("packing", pack),
]

ORACLE_SQL = None  # no stage has a form in SQL; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the checkpoint folder and read again."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/corpus-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
