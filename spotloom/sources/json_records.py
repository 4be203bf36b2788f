"""Records of large JSON files, read in splits.

Spark's text reader cuts a file at closing braces, so that one long line still spreads
over tasks. Whether a split begins within a string, and how deep, follows from the splits
before it: each is summed up for both possible beginnings, one row a split, and a running
pass over these rows tells where each one begins. A second scan then gives the records,
and what of a record lies in other splits is put together.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_TOKEN = re.compile(r'\\.|["{\[\]]', re.S)
_COLON = re.compile(r"\s*:")
_AT = ["file", "block"]


def _events(text: str, quoted: bool) -> tuple[list[tuple[int, str, str | None]], bool]:
    """(place, kind, name) of keys, openings and closings up to a brace that ``text`` has lost."""
    out: list[tuple[int, str, str | None]] = []
    start = 0
    for found in _TOKEN.finditer(text):
        token = found.group()
        if token == '"':
            quoted = not quoted
            if quoted:
                start = found.end()
            elif _COLON.match(text, found.end()):
                out.append((found.start(), "key", text[start : found.start()]))
        elif not quoted and token in "{[]":
            out.append((found.start(), token, None))
    if not quoted:
        out.append((len(text), "}", None))
    return out, quoted


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, seq, value): texts between closing braces, in order of seq in a split."""
    rows = spark.read.option("lineSep", "}").text(path)
    return rows.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        "value",
    )


def _beginnings(chunks: DataFrame) -> DataFrame:
    """(file, block, quoted, depth, section): the state each split begins with.

    ``section`` is the last key of the outermost object before the split.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        for batch in batches:
            for file, block, text in zip(*(batch.column(c).to_pylist() for c in (*_AT, "value")), strict=True):
                if not rows or (rows[-1]["file"], rows[-1]["block"]) != (file, block):
                    rows.append({"file": file, "block": block, "ways": [
                        {"quoted": first, "depth": 0, "keys": {}} for first in (False, True)
                    ]})
                for way in rows[-1]["ways"]:
                    events, way["quoted"] = _events(text, way["quoted"])
                    for _, kind, name in events:
                        if kind == "key":
                            way["keys"][way["depth"]] = name
                        else:
                            way["depth"] += 1 if kind in "{[" else -1
        for row in rows:
            for way in row["ways"]:
                way["keys"] = list(way["keys"].items())
        way = pa.struct([("quoted", pa.bool_()), ("depth", pa.int32()), ("keys", pa.map_(pa.int32(), pa.string()))])
        kinds = pa.schema([("file", pa.string()), ("block", pa.int64()), ("ways", pa.list_(way))])
        yield pa.RecordBatch.from_pylist(rows, kinds)

    def follow(splits: pd.DataFrame) -> pd.DataFrame:
        quoted, depth, section, out = False, 0, None, []
        for row in splits.sort_values("block").itertuples():
            out.append((row.file, row.block, quoted, depth, section))
            way = row.ways[int(quoted)]
            section = dict(way["keys"]).get(1 - depth, section)
            quoted, depth = bool(way["quoted"]), depth + int(way["depth"])
        return pd.DataFrame(out, columns=[*_AT, "quoted", "depth", "section"])

    sums = chunks.select(*_AT, "value").mapInArrow(
        run, "file string, block long, ways array<struct<quoted: boolean, depth: int, keys: map<int, string>>>"
    )
    return sums.groupBy("file").applyInPandas(
        follow, "file string, block long, quoted boolean, depth int, section string"
    )


def _pieces(begun: DataFrame, wanted: str) -> DataFrame:
    """(file, block, k, key, value, closed): records and parts of records by split.

    k counts the records that begin in the split; 0 goes on from an earlier one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, inside, out = None, False, []
        k = depth = home = 0
        key = section = own = None
        quoted, held = False, []

        def leave() -> None:
            if inside:
                out.append((*at, k, key, "".join(held), False))

        def level() -> int:
            return 1 if section is None else 2 if section == wanted else -1

        for batch in batches:
            names = (*_AT, "value", "quoted", "depth", "section")
            for file, block, text, q, d, s in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                if at != (file, block):
                    leave()
                    at, quoted, depth, section = (file, block), q, d, s
                    home, k, key, own, held = level(), 0, None, None, []
                    inside = home > 0 and depth > home
                begin = 0
                events, quoted = _events(text, quoted)
                for place, kind, name in events:
                    if kind == "key":
                        if depth == 1:
                            section, own = name, None
                        elif depth == 2 and not inside:
                            own = name
                    elif kind in "{[":
                        if kind == "{" and not inside and depth == level():
                            inside, home, k, key, begin = True, depth, k + 1, own, place
                        depth += 1
                    else:
                        depth -= 1
                        if inside and depth == home:
                            held.append(text[begin:place] + kind)
                            out.append((*at, k, key, "".join(held), True))
                            inside, held, own = False, [], None
                if inside:
                    held.append(text[begin:] + "}")
            yield table(out)
            out = []
        leave()
        yield table(out)

    def table(rows: list[tuple]) -> pa.RecordBatch:
        names = [*_AT, "k", "key", "value", "closed"]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_()]
        columns = list(zip(*rows, strict=True)) or [[] for _ in names]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    return begun.mapInArrow(run, "file string, block long, k long, key string, value string, closed boolean")


def json_records(spark: SparkSession, path: str, section: str) -> DataFrame:
    """(file, block, k, key, value): the JSON text of every record of the files at ``path``.

    Records are the objects of the list or object that the key ``section`` of the
    outermost object holds, with their own key in the latter case; of a bare list they
    are its objects. (file, block, k) is their order. Keys hold no closing brace.
    """
    chunks = _chunks(spark, path)
    begun = chunks.join(_beginnings(chunks), _AT).sortWithinPartitions(*_AT, "seq")
    pieces = _pieces(begun, section)
    whole = pieces.filter("k > 0 AND closed").drop("closed")
    cut = pieces.filter("k = 0 OR NOT closed")  # two rows a split at most
    first = F.when(F.col("k") > 0, F.struct("block", "k", "key"))
    before = Window.partitionBy("file").orderBy("block", "k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    owned = cut.withColumn("owner", F.last(first, ignorenulls=True).over(before))
    # Parts of one record are in order of their splits.
    joined = owned.groupBy("file", "owner").agg(F.sort_array(F.collect_list(F.struct("block", "value"))).alias("parts"))
    return whole.unionByName(
        joined.select("file", "owner.block", "owner.k", "owner.key", F.concat_ws("", "parts.value").alias("value"))
    )
