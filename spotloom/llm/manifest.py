"""Merkle manifest of a table: one digest for all rows, one proof for each.

Rows are ranked within their group and cut into aligned blocks. A block hashes its
subtree on its own. Then the blocks work in a butterfly: in each round, aligned groups
of blocks whose numbers differ only in the next ``RADIX_BITS`` bits swap the roots they
hold, and every member hashes the ancestors of all of them. Each ancestor is so hashed
by many blocks, and each block ends with all the siblings on its own way to the root; no
pass goes back down. The subroots of the groups form a tree of the same kind.

Every two consecutive nodes become one; a last node without a neighbour is hashed alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage

BLOCK_BITS = 12  # rows of a block: 2^12
RADIX_BITS = 4  # blocks that swap roots in a round: 2^4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field_bytes(value: Column) -> Column:
    """A field as it enters a leaf: its length in bytes, a colon and the value; '-' if null."""
    shown = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(shown).cast("string"), F.lit(":"), shown), F.lit("-"))


def leaf_digest(values: list[Column]) -> Column:
    return F.sha2(F.concat(*[field_bytes(v) for v in values]), 256)


def levels_of(n: int) -> int:
    """Levels above n leaves; none above a lone one."""
    return max(0, (n - 1).bit_length())


def ranked(nodes: DataFrame, order: list[str]) -> DataFrame:
    """Add ``pos`` (from 0 in its group ``g``, by ``order``) and ``n`` (rows of the group).

    The table is sorted over ranges and written once. Only the first and the last group of
    a range reach beyond it, so one small row for each range tells all places.
    """
    spark = nodes.sparkSession
    keys = ["g", *order]
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), spark.sparkContext.defaultParallelism)
    # rows that are equal in all keys are interchangeable; a number lets ranges cut between them
    numbered = nodes.withColumn("_tie", F.monotonically_increasing_id())
    ranges = numbered.repartitionByRange(tasks, *keys, "_tie").sortWithinPartitions(*keys, "_tie").drop("_tie")
    ranges = cut_lineage(ranges)

    def ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first = last = None
        head = tail = 0
        for batch in batches:
            for g, size in batch.groupby("g", sort=False).size().items():
                if first is None:
                    first = g
                if g != last:
                    last, tail = g, 0
                tail += int(size)
                if g == first:
                    head += int(size)
        if first is not None:
            part = TaskContext.get().partitionId()
            yield pd.DataFrame({"part": [part], "first": [first], "head": [head], "last": [last], "tail": [tail]})

    # one row for each range, not for each group
    summary = sorted(ranges.select("g").mapInPandas(ends, "part int, first string, head long, last string, tail long").collect())
    before: dict[int, int] = {}  # rows of the first group in earlier ranges
    total: dict[str, int] = {}  # size of each group that is first or last in a range
    for part, first, head, last, tail in summary:
        before[part] = total.get(first, 0)
        total[first] = before[part] + head
        if last != first:
            total[last] = tail
    known = spark.sparkContext.broadcast(
        {part: (before[part], first, total[first], last, total[last]) for part, first, _, last, _ in summary}
    )

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        held: list[pd.DataFrame] = []  # an inner group is held until its size is known
        current, at = None, 0

        def flush(n: int) -> Iterator[pd.DataFrame]:
            for chunk in held:
                chunk["n"] = n
                yield chunk
            held.clear()

        for batch in batches:
            start, first, n_first, last, n_last = known.value[part]
            sizes = {first: n_first, last: n_last}
            for g, chunk in batch.groupby("g", sort=False):
                if g != current:
                    yield from flush(at)
                    current, at = g, (start if g == first else 0)
                chunk = chunk.assign(pos=range(at, at + len(chunk)))
                at += len(chunk)
                held.append(chunk)
                if g in sizes:
                    yield from flush(sizes[g])
        yield from flush(at)

    schema = T.StructType([*ranges.schema.fields, T.StructField("pos", T.LongType()), T.StructField("n", T.LongType())])
    return ranges.mapInPandas(place, schema)


def local_levels(digests: list[str], n_levels: int) -> list[list[str]]:
    """Nodes of a block, level by level from its leaves to its root."""
    out = [digests]
    for _ in range(n_levels):
        low = out[-1]
        out.append([h("".join(low[i : i + 2])) for i in range(0, len(low), 2)])
    return out


def _block_levels(n: int, bits: int) -> int:
    return min(levels_of(n), bits)


def block_roots(placed: DataFrame, bits: int) -> DataFrame:
    """(g, b, blocks, digest): the root of every block and the number of blocks of its group."""

    def roots(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        n = int(rows["n"].iloc[0])
        top = local_levels(rows["digest"].tolist(), _block_levels(n, bits))[-1]
        return pd.DataFrame({"g": [key[0]], "b": [key[1]], "blocks": [-(-n // (1 << bits))], "digest": top})

    small = placed.select("g", F.shiftright("pos", bits).alias("b"), "pos", "n", "digest")
    return small.groupBy("g", "b").applyInPandas(roots, "g string, b long, blocks long, digest string")


def _parents(nodes: Column) -> Column:
    """The level above an array of digests."""

    def parent(k: Column) -> Column:
        return F.sha2(F.concat(F.get(nodes, 2 * k), F.coalesce(F.get(nodes, 2 * k + 1), F.lit(""))), 256)

    return F.transform(F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / 2).cast("int")), parent)


def butterfly(roots: DataFrame, radix_bits: int = RADIX_BITS) -> DataFrame:
    """(g, b, path, top): for every block the siblings above it ('' where none) and its group's root."""
    roots = cut_lineage(roots)
    most = roots.agg(F.max("blocks").alias("m")).first()["m"] or 1
    state = roots.withColumn("path", F.array().cast("array<string>"))
    fan = 1 << radix_bits
    for done in range(0, levels_of(most), radix_bits):
        stride = 1 << done
        # nodes of the group at this level; block b holds node i, its lane is what it has below
        nodes = F.expr(f"(blocks + {stride - 1}) div {stride}")
        open_ = state.filter(F.col("blocks") > stride).withColumn("nodes", nodes)
        closed = state.filter(F.col("blocks") <= stride)
        lane = F.col("b") % stride
        # a short last node has fewer holders than lanes: its last block stands in for the others
        absent = F.sequence(lane + 1, F.lit(stride - 1).cast("long"))
        stands = (F.col("b") == F.col("blocks") - 1) & (lane < stride - 1) & ((F.col("nodes") - 1) % fan > 0)
        lanes = F.when(stands, F.concat(F.array(lane), absent)).otherwise(F.array(lane))
        node = F.expr(f"b div {stride}")
        held = F.struct(node.alias("i"), "digest", "b", "path", (F.col("lane") == lane).alias("own"))
        swapped = (
            open_.withColumn("lane", F.explode(lanes))
            .groupBy("g", "blocks", "nodes", F.expr(f"b div {stride * fan}").alias("q"), "lane")
            .agg(F.sort_array(F.collect_list(held)).alias("held"))  # at most ``fan`` members
            .withColumn("level_0", F.transform("held", lambda x: x["digest"]))
        )
        for step in range(radix_bits):
            low = F.col(f"level_{step}")
            rises = F.when(F.col("nodes") > (1 << step), _parents(low)).otherwise(low)
            swapped = swapped.withColumn(f"level_{step + 1}", rises)
        member = swapped.withColumn("m", F.explode(F.filter("held", lambda x: x["own"])))
        spot = (F.col("m.i") % fan).cast("int")
        beside = [
            F.when(
                F.col("nodes") > (1 << step),
                F.array(F.coalesce(F.get(f"level_{step}", F.shiftright(spot, step).bitwiseXOR(F.lit(1))), F.lit(""))),
            ).otherwise(F.array().cast("array<string>"))
            for step in range(radix_bits)
        ]
        above = F.get(f"level_{radix_bits}", F.lit(0))
        risen = member.select(
            "g", F.col("m.b").alias("b"), "blocks", above.alias("digest"), F.concat("m.path", *beside).alias("path")
        )
        state = risen.unionByName(closed.select(*risen.columns))
    return state.select("g", "b", "path", F.col("digest").alias("top"))


def fold(digest: str, pos: int, siblings: list[str]) -> str:
    """The root that a digest at ``pos`` and its siblings, level by level, lead to."""
    for other in siblings:
        digest = h(other + digest if pos & 1 else digest + other)
        pos >>= 1
    return digest


def forest(leaves: DataFrame, order: list[str], bits: int = BLOCK_BITS, radix_bits: int = RADIX_BITS) -> tuple[DataFrame, DataFrame]:
    """(placed leaves, blocks): positions of the leaves and what each block knows of the tree above it."""
    placed = cut_lineage(ranked(leaves, order))
    return placed, butterfly(block_roots(placed, bits), radix_bits)


PROOF = "g string, doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def manifest(docs: DataFrame, tampered: Column | None = None, bits: int = BLOCK_BITS, radix_bits: int = RADIX_BITS) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row.

    Where ``tampered`` holds, ``folded_root`` is recomputed from the row with 1 added to
    n_chars (a null stays), else from the row itself; ``verified`` tells whether it is the root.

    Nulls have a form of their own in a leaf. Null ids come first, equal ids are ordered by
    leaf; equal rows are leaves of their own. Empty and long texts are hashed whole. Other
    columns are ignored. An empty table gives no rows.
    """
    columns = [F.col(c) for c in FIELDS]
    changed = [F.col(c).cast("decimal(20,0)") + 1 if c == "n_chars" else F.col(c) for c in FIELDS]
    marked = F.lit(False) if tampered is None else F.coalesce(tampered, F.lit(False))
    leaves = cut_lineage(
        docs.select(
            F.coalesce(F.concat(F.lit("1"), F.col("lang")), F.lit("0")).alias("g"),  # the null group first
            F.col("doc_id").cast("long").alias("doc_id"),
            leaf_digest(columns).alias("digest"),
            F.when(marked & F.col("n_chars").isNotNull(), leaf_digest(changed)).alias("other"),
        )
    )
    placed, blocks = forest(leaves, ["doc_id", "digest"], bits, radix_bits)
    blocks = cut_lineage(blocks)
    groups = blocks.filter("b = 0").select(F.lit("").alias("g"), F.col("g").alias("name"), F.col("top").alias("digest"))
    heads, over = forest(groups, ["name"], bits, radix_bits)
    tops = _proofs_of_groups(heads, over, bits)
    known = blocks.join(tops.withColumnRenamed("name", "g"), "g")

    def prove(key: tuple, rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        n, b = int(rows["n"].iloc[0]), int(key[1])
        own = above.iloc[0]
        levels = local_levels(rows["digest"].tolist(), _block_levels(n, bits))
        out = []
        for at, (doc, leaf, other) in enumerate(zip(rows["doc_id"], rows["digest"], rows["other"], strict=True)):
            near = [
                level[i] if (i := (at >> k) ^ 1) < len(level) else "" for k, level in enumerate(levels[:-1])
            ]
            way = [*near, *own["path"]]
            sub = fold(other if isinstance(other, str) else leaf, (b << bits) + at, way)
            root = fold(sub, int(own["place"]), list(own["ways"]))
            proof = h("".join([*way, *own["ways"]]))
            out.append((key[0], doc, leaf, own["top"], own["root"], proof, root, root == own["root"]))
        frame = pd.DataFrame(out, columns=["g", "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])
        return frame.astype({"doc_id": "Int64"})

    grouped = placed.withColumn("b", F.shiftright("pos", bits)).groupBy("g", "b")
    return grouped.cogroup(known.groupBy("g", "b")).applyInPandas(prove, PROOF).drop("g")


def _proofs_of_groups(heads: DataFrame, over: DataFrame, bits: int) -> DataFrame:
    """(name, place, ways, root): the way from the subroot of each group to the root."""

    def prove(key: tuple, rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        own = above.iloc[0]
        levels = local_levels(rows["digest"].tolist(), _block_levels(int(rows["n"].iloc[0]), bits))
        ways = [
            [*(level[i] if (i := (at >> k) ^ 1) < len(level) else "" for k, level in enumerate(levels[:-1])), *own["path"]]
            for at in range(len(rows))
        ]
        return pd.DataFrame({"name": rows["name"].tolist(), "place": rows["pos"].tolist(), "ways": ways, "root": own["top"]})

    grouped = heads.withColumn("b", F.shiftright("pos", bits)).groupBy("g", "b")
    return grouped.cogroup(over.groupBy("g", "b")).applyInPandas(
        prove, "name string, place long, ways array<string>, root string"
    )
