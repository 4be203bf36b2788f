"""Sanitising texts by what their terms give away.

Base patterns find e-mail addresses, IP addresses, card and phone numbers; each distinct
value is a protected entity. A term near an entity can give it away even after the value
itself is gone. How much it does is measured over the corpus: with N different texts,
entity c in n_c of them, term t in n_t, and t within ``WINDOW`` terms of c in n_ct,

    disclosure = log2(n_ct * N / (n_c * n_t)) / log2(N / n_c)

is the share of the information of c that t reveals: 1 where t is found only beside c,
0 where t says nothing about c. A term at or above the threshold is generalised to its
first letters if that beginning, measured in the same way, stays below the threshold for
every entity; else it is removed. n_c, n_t and n_ct count different surroundings (the terms
around c or t), so that copies and near copies of a text are not evidence for each other,
and a term needs ``SUPPORT`` of them.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator, Sequence

import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .rows import ROW

KINDS = ("email", "ip", "card", "phone")
GENERALISED, REMOVED = "generalised", "removed"
WINDOW = 8  # terms on each side of an entity
SUPPORT = 3  # different surroundings in which a term must stand beside an entity
DISCLOSURE = 0.9  # share of an entity's information that a term may reveal
STEM = 3  # letters that a generalised term keeps
SHIPPED = 200_000  # terms sent to every task at most; more go through a join
HELD = 200_000  # counts that a task holds before it emits them

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]")
TERM = re.compile(r"\w{3,}")
LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

Span = tuple[int, int]


def _emails(text: str) -> list[Span]:
    """One look at the name before and the host after each @; a name starts after the last match."""
    out, free = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LETTERS:
            start -= 1
        host = DOMAIN.match(text, at + 1) if start < at else None
        if host:
            out.append((start, host.end()))
            free = host.end()
        at = text.find("@", max(at + 1, free))
    return out


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _byte(digits: str) -> bool:
    digits = digits.lstrip("0")  # 0001 is small
    return len(digits) < 4 and int(digits or 0) < 256


def _ips(text: str) -> list[Span]:
    return [m.span() for m in IP.finditer(text) if all(_byte(p) for p in m.group().split("."))]


def _cards(text: str) -> list[Span]:
    out = []
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and _luhn(digits):
            out.append(m.span())
    return out


def _phones(text: str) -> list[Span]:
    return [m.span() for m in PHONE.finditer(text) if 8 <= sum("0" <= c <= "9" for c in m.group()) <= 15]


def base_spans(text: str) -> dict[str, list[Span]]:
    """Spans of each kind in code points; empty where a text holds neither @ nor digits."""
    digits = DIGITS.search(text) is not None
    return {
        "email": _emails(text) if "@" in text else [],
        "ip": _ips(text) if digits else [],
        "card": _cards(text) if digits else [],
        "phone": _phones(text) if digits and "+" in text else [],
    }


def entity(kind: str, value: str) -> str:
    """What names a value: letter case and the marks between digits do not matter."""
    if kind == "email":
        return f"{kind}:{value.lower()}"
    return f"{kind}:{value}" if kind == "ip" else f"{kind}:{''.join(DIGITS.findall(value))}"


def masked(text: str, spans: dict[str, list[Span]]) -> str:
    """The text with blanks for its base spans, so that places stay."""
    out, at = [], 0
    for start, stop in sorted(s for own in spans.values() for s in own):
        if stop > at:
            start = max(start, at)
            out += [text[at:start], " " * (stop - start)]
            at = stop
    return "".join([*out, text[at:]])


def beginning(term: str) -> str | None:
    """The generalised form of a term; none for terms that are no longer than it."""
    return term[:STEM] + "*" if len(term) > STEM else None


def with_beginnings(terms: set[str]) -> set[str]:
    """Terms and their generalised forms."""
    return terms | {s for t in terms if (s := beginning(t))}


def terms_of(text: str) -> set[str]:
    """Different terms of a text without its base spans."""
    spans = base_spans(text)
    plain = masked(text, spans) if any(spans.values()) else text
    return set(map(str.lower, TERM.findall(plain)))


def _around(terms: list[str]) -> int:
    return xxhash.xxh3_64_intdigest(" ".join(terms).encode("utf-8", "surrogatepass")) >> 1


def surroundings(text: str, window: int = WINDOW) -> dict[tuple[str, str], int]:
    """(entity, term or beginning near it) -> hash of the terms around; (entity, '') for the entity itself.

    Of several places in one text the one with the least hash counts.
    """
    spans = base_spans(text)
    if not any(spans.values()):
        return {}
    plain = masked(text, spans)
    words = [(m.start(), m.group().lower()) for m in TERM.finditer(plain)]
    starts = [start for start, _ in words]
    out: dict[tuple[str, str], int] = {}
    for kind, own in spans.items():
        for start, stop in own:
            name = entity(kind, text[start:stop])
            left = bisect_left(starts, start)
            right = bisect_left(starts, stop)
            near = [w for _, w in words[max(0, left - window) : left] + words[right : right + window]]
            around = _around(near)
            for term in with_beginnings(set(near)) | {""}:
                key = (name, term)
                out[key] = min(around, out.get(key, around))
    return out


def _texts(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[list[str]]:
    for batch in batches:
        yield batch.column(column).to_pylist()


def near_entities(texts: DataFrame, window: int = WINDOW) -> DataFrame:
    """(c, t, n): different surroundings of entity c that hold term t; t = '' counts those of c."""

    def counted(found: set) -> pa.RecordBatch:
        c, t, around = zip(*found, strict=True) if found else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string()), pa.array(t, pa.string()), pa.array(around, pa.int64())], ["c", "t", "around"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: set[tuple[str, str, int]] = set()
        for batch in _texts(batches, 0):
            for text in batch:
                found.update((c, t, around) for (c, t), around in surroundings(text, window).items())
                if len(found) > HELD:
                    yield counted(found)
                    found.clear()
        yield counted(found)

    seen = texts.mapInArrow(run, "c string, t string, around long")
    return seen.distinct().groupBy("c", "t").agg(F.count("*").alias("n"))


def term_surroundings(texts: DataFrame, most: Broadcast | None, window: int = WINDOW) -> DataFrame:
    """(t, n): different surroundings of a term or beginning, at its first place in each text.

    With ``most`` (term -> number) only its terms, and only those with at most so many: a
    task that has seen more of a term says just that, so that words found everywhere cost
    one row a task.
    """

    def places(text: str, wanted: dict[str, int] | None) -> Iterator[tuple[str, int]]:
        spans = base_spans(text)
        words = list(map(str.lower, TERM.findall(masked(text, spans) if any(spans.values()) else text)))
        first: dict[str, int] = {}
        for i, word in enumerate(words):
            first.setdefault(word, i)
        for word, i in list(first.items()):
            stem = beginning(word)
            if stem and i < first.get(stem, i + 1):
                first[stem] = i
        for term, i in first.items():
            if wanted is None or term in wanted:
                yield term, _around(words[max(0, i - window) : i + window + 1])

    def table(found: list[tuple[str, int | None]]) -> pa.RecordBatch:
        t, around = zip(*found, strict=True) if found else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(t, pa.string()), pa.array(around, pa.int64())], ["t", "around"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = None if most is None else dict(most.value)
        seen: dict[str, set[int]] = {}
        over: list[tuple[str, int | None]] = []
        held = 0
        for batch in _texts(batches, 0):
            for text in batch:
                for term, around in places(text, open_):
                    own = seen.setdefault(term, set())
                    held -= len(own)
                    own.add(around)
                    if open_ is not None and len(own) > open_[term]:
                        over.append((term, None))
                        del open_[term], seen[term]
                    else:
                        held += len(own)
                if held > HELD:
                    yield table([(t, x) for t, own in seen.items() for x in own])
                    seen, held = {}, 0
        yield table([(t, x) for t, own in seen.items() for x in own] + over)

    counted = texts.mapInArrow(run, "t string, around long").distinct().groupBy("t")
    counted = counted.agg(F.count("*").alias("n"), F.bool_or(F.col("around").isNull()).alias("over"))
    return counted.filter("NOT over").select("t", "n")


def disclosing(
    docs: DataFrame, threshold: float = DISCLOSURE, support: int = SUPPORT, window: int = WINDOW, shipped: int = SHIPPED
) -> DataFrame:
    """(t, action) of every term that reveals a protected entity; written once."""
    texts = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    near = cut_lineage(near_entities(texts, window).filter(F.col("n") >= support))
    n = float(texts.select(F.xxhash64("text").alias("h")).distinct().count())
    entities = near.filter("t = ''").select("c", F.col("n").alias("n_c")).filter(F.col("n_c") < n)
    pairs = near.filter("t != ''").select("c", "t", F.col("n").alias("n_ct")).join(entities, "c")
    # the threshold turned around: with more surroundings than this a term is not revealing
    bound = F.floor(F.col("n_ct") * F.pow(n / F.col("n_c"), F.lit(1.0 - threshold))) + 1
    bounds = pairs.groupBy("t").agg(F.max(bound).alias("most"))
    few = bounds.limit(shipped + 1).collect()
    if not few:
        return docs.sparkSession.createDataFrame([], "t string, action string")
    sent = docs.sparkSession.sparkContext.broadcast({r["t"]: r["most"] for r in few}) if len(few) <= shipped else None
    terms = term_surroundings(texts, sent, window).withColumnRenamed("n", "n_t")
    measured = pairs.join(terms, "t")
    inform = F.log2(n / F.col("n_c"))
    share = F.log2(F.least("n_ct", "n_t") * n / (F.col("n_c") * F.col("n_t"))) / inform
    revealing = measured.groupBy("t").agg(F.max(share).alias("d")).filter(F.col("d") >= threshold)
    revealing = cut_lineage(revealing)
    stems = revealing.filter(F.col("t").endswith("*")).select(F.col("t").alias("stem"), F.lit(True).alias("open"))
    words = revealing.filter(~F.col("t").endswith("*")).withColumn(
        "stem", F.when(F.char_length("t") > STEM, F.concat(F.substring("t", 1, STEM), F.lit("*"))).otherwise(F.col("t"))
    )
    kept = F.col("open").isNull() & (F.char_length("t") > STEM)
    action = F.when(kept, GENERALISED).otherwise(REMOVED)
    return cut_lineage(words.join(stems, "stem", "left").select("t", action.alias("action")))


def term_spans(text: str, spans: dict[str, list[Span]], actions: dict[str, str]) -> list[tuple[str, int, int]]:
    """(action, start, end) of the terms that are generalised or removed."""
    plain = masked(text, spans) if any(spans.values()) else text
    if not actions or actions.keys().isdisjoint(map(str.lower, TERM.findall(plain))):
        return []
    out = [(actions.get(m.group().lower()), *m.span()) for m in TERM.finditer(plain)]
    return sorted(x for x in out if x[0])


def sanitised(text: str, spans: Sequence[tuple[str, int, int]]) -> str:
    """The text with a mark for each personal value, beginnings of generalised terms, and without removed ones.

    Where base spans overlap, the one that starts first (then the earlier kind) gives the mark of both.
    """
    rank = {kind: i for i, kind in enumerate((*KINDS, GENERALISED, REMOVED))}
    out, at = [], 0
    for kind, start, stop in sorted(spans, key=lambda s: (s[1], rank[s[0]])):
        if start >= at:
            out.append(text[at:start])
            out.append(text[start : start + STEM] + "*" if kind == GENERALISED else f"[{kind}]" if kind in KINDS else "[...]")
        at = max(at, stop)
    return "".join([*out, text[at:]])


def sanitise(
    docs: DataFrame,
    row: str = ROW,
    threshold: float = DISCLOSURE,
    support: int = SUPPORT,
    window: int = WINDOW,
    texts: bool = True,
    shipped: int = SHIPPED,
) -> DataFrame:
    """(row, spans, text) of every document of (row, text); ``row`` names it, see ``rows.with_row``.

    ``spans`` lists (kind, start, end) in code points, base kinds first and in the order of
    KINDS, then generalised and removed terms; each kind ascends. ``text`` is sanitised,
    null for a null text, and left out without ``texts``.

    A null text counts as empty. Repeated rows count as texts of their own and give the
    same spans. Long texts are read whole. Other columns are ignored. An empty table
    gives no rows.
    """
    found = disclosing(docs, threshold, support, window, shipped)
    rows = docs.select(F.col(row).alias("_id"), F.col("text").cast("string").alias("text"))
    listed = found.limit(shipped + 1).collect()
    if len(listed) <= shipped:
        actions = {r["t"]: r["action"] for r in listed}
        sent = docs.sparkSession.sparkContext.broadcast(actions)
        return _applied(rows, row, texts, sent)
    return _applied(_with_own(rows, found), row, texts, None)


def _with_own(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows with those of their terms that are generalised or removed: a join on terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(batch.column(1).to_pylist()):
                terms = sorted(terms_of(text or ""))
                ids = batch.column(0).slice(i, 1).take(pa.array([0] * len(terms), pa.int32()))
                yield pa.RecordBatch.from_arrays([ids, pa.array(terms, pa.string())], ["_id", "t"])

    kind = rows.schema["_id"].dataType
    schema = T.StructType([T.StructField("_id", kind), T.StructField("t", T.StringType())])
    pairs = rows.mapInArrow(run, schema).join(found, "t")
    own = pairs.groupBy("_id").agg(F.map_from_entries(F.collect_list(F.struct("t", "action"))).alias("own"))
    return rows.join(own, "_id", "left")


def _applied(rows: DataFrame, row: str, texts: bool, sent: Broadcast | None) -> DataFrame:
    span = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    fields = [T.StructField(row, rows.schema["_id"].dataType), T.StructField("spans", T.ArrayType(span))]
    fields += [T.StructField("text", T.StringType())] * texts
    arrow_span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(2).to_pylist() if sent is None else None
            spans, clean = [], []
            for i, value in enumerate(batch.column(1).to_pylist()):
                text = value or ""
                base = base_spans(text)
                actions = sent.value if own is None else dict(own[i] or ())
                marks = [(k, *s) for k in KINDS for s in base[k]] + term_spans(text, base, actions)
                spans.append([{"kind": k, "start": a, "end": b} for k, a, b in marks])
                if texts:
                    clean.append(None if value is None else sanitised(text, marks))
            columns = [batch.column(0), pa.array(spans, arrow_span)] + [pa.array(clean, pa.string())] * texts
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    return rows.mapInArrow(run, T.StructType(fields))


def how_many(kind: str) -> Column:
    """Number of spans of a kind."""
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def listed(kinds: Sequence[str] | None = None) -> Column:
    """kind:start:end of the spans of some kinds (all by default), comma-joined in their order."""
    chosen = F.col("spans") if kinds is None else F.filter("spans", lambda s: s["kind"].isin(list(kinds)))
    parts = F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(parts, ",")
