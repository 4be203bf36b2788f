"""Balanced label propagation over linked documents, with DataFrame operations only.

Documents with equal texts are linked. A document sees how its links are spread over the
shards, wants the shard where most of them are, and moves if that shard's quota has room.
Votes are counted per group of links before they are joined back, so a group of copies
costs one row per group however large it is. The last step puts the documents in order
of label and group and cuts that order into equal parts: sizes are exact, and only
groups that lie across a cut, or exceed a shard, lose links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .rows import ROW, with_row


def propagate(nodes: DataFrame, shards: int, rounds: int = 5) -> DataFrame:
    """Labels after ``rounds`` moves of linked rows towards their links' shards.

    ``nodes`` has _row and link (a group key; null links nothing); adds label, int. In
    round t a row that is in none of the t + 1 shards with most of its links wants the
    last of these, so that a group beyond one shard's quota fills a few shards. Rows
    without links have no wish and take the room that is left.
    """
    labelled = nodes.withColumn("label", F.pmod(F.xxhash64(F.lit(11), ROW), F.lit(shards)).cast("int"))
    total = F.broadcast(nodes.agg(F.count("*").alias("total")))  # a single row
    for turn in range(rounds):
        votes = (
            labelled.filter("link IS NOT NULL")
            .groupBy("link")
            .agg(
                F.count("*").alias("k"),
                F.array(*[F.sum((F.col("label") == s).cast("long")) for s in range(shards)]).alias("votes"),
            )
            .filter("k > 1")
        )
        # equal votes: a shard that depends on the group, so that groups spread
        ranked = F.transform(
            "votes",
            lambda v, s: F.struct(v.alias("v"), F.pmod(F.xxhash64("link", s), F.lit(1 << 20)).alias("t"), s.cast("int").alias("s")),
        )
        order = votes.select("link", F.transform(F.sort_array(ranked, asc=False), lambda x: x["s"]).alias("order"))
        place = F.array_position("order", F.col("label"))
        wanting = labelled.join(order, "link", "left").withColumn(
            "wish", F.when(place <= turn + 1, F.col("label")).otherwise(F.element_at("order", turn + 1))
        )
        # linked rows that stay use up the quota first; the rest is shared out among those that come
        load = wanting.filter("wish IS NOT NULL").groupBy("wish").agg(
            F.sum((F.col("wish") == F.col("label")).cast("long")).alias("stay"),
            F.sum((F.col("wish") != F.col("label")).cast("long")).alias("come"),
        )
        room = F.greatest(F.ceil(F.col("total") / shards) - F.col("stay"), F.lit(0))
        share = load.crossJoin(total).select("wish", (room / F.greatest("come", F.lit(1))).alias("share"))
        draw = F.pmod(F.xxhash64(F.lit(turn), "link", ROW), F.lit(1 << 30)) / F.lit(float(1 << 30))
        labelled = cut_lineage(
            wanting.join(F.broadcast(share), "wish", "left")  # one row per shard
            .withColumn("label", F.when(draw < F.col("share"), F.col("wish")).otherwise(F.col("label")))
            .select(*nodes.columns, "label", F.col("order").isNotNull().alias("linked"))
        ).select(*nodes.columns, "label", "linked")
        if turn < rounds - 1:
            labelled = labelled.drop("linked")
    used = labelled.groupBy().agg(
        F.array(*[F.sum((F.col("linked") & (F.col("label") == s)).cast("long")) for s in range(shards)]).alias("used"),
        F.count("*").alias("total"),
    )
    free = used.select(
        F.transform("used", lambda u: F.greatest(F.ceil(F.col("total") / shards) - u, F.lit(0))).alias("free")
    ).select(
        F.transform("free", lambda f, i: F.aggregate(F.slice("free", 1, i + 1), F.lit(0).cast("long"), lambda a, x: a + x)).alias("upto")
    )
    spot = F.pmod(F.xxhash64(F.lit(13), ROW), F.greatest(F.element_at("upto", -1), F.lit(1)))
    fill = F.size(F.filter("upto", lambda u: u <= spot)).cast("int")
    return labelled.crossJoin(F.broadcast(free)).select(  # a single row
        *nodes.columns, F.when(F.col("linked"), F.col("label")).otherwise(F.least(fill, F.lit(shards - 1))).alias("label")
    )


def in_order(df: DataFrame, *order: str) -> DataFrame:
    """Add ``rank``, gapless from 0 in the order of the columns, without a global sort in one task.

    Rows are range partitioned, sorted within partitions and written once; the counts of
    the partitions give each its first rank.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    placed = cut_lineage(
        df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    )
    part = F.shiftright("_at", 33)
    totals = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    within = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(bases), "_part")  # one row per partition
        .withColumn("rank", F.col("_base") + within)
        .drop("_at", "_part", "_base")
    )


def shard(docs: DataFrame, shards: int = 16, rounds: int = 5) -> DataFrame:
    """All documents in ``shards`` shards whose counts are at most one apart (law ``rows``).

    Columns: doc_id, size (UTF-8 bytes and one), text_crc32, law, shard, slot (gapless
    from 0 within the shard), grown_shard (null under this law). A null text has size 1
    and the checksum 0, like an empty one, and links nothing; repeated rows are linked
    and placed each; null ids are placed too. An empty table gives no rows.
    """
    rows = with_row(docs.select("doc_id", "text"))
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    nodes = rows.select(
        "doc_id", ROW,
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.when(F.col("text").isNotNull(), F.xxhash64("text")).alias("link"),
    )
    nodes = cut_lineage(nodes)
    labelled = propagate(nodes, shards, rounds)
    ranked = in_order(labelled.withColumn("own", F.coalesce("link", F.xxhash64(ROW))), "label", "own", ROW)
    total = nodes.agg(F.count("*").alias("total"))
    whole = ranked.crossJoin(F.broadcast(total))  # a single row
    return whole.select(
        "doc_id", "size", "text_crc32",
        F.lit("rows").alias("law"),
        F.expr(f"int(((rank + 1) * {shards} - 1) div total)").alias("shard"),
        "rank", "total",
    ).select(
        "doc_id", "size", "text_crc32", "law", "shard",
        (F.col("rank") - F.expr(f"(shard * total) div {shards}")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
